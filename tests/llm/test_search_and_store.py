"""Lexical search, Merkle manifest and sharding against plain versions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from swishline.llm import lexical, merkle, sharding
from swishline.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# --- lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def best_by_hand(docs, items, k=10):
    """Every document scored for every item, from the definition."""
    said = [(i, terms_of(t)) for i, t in docs]
    held = [(i, t) for i, t in said if t]
    documents, total = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, t in held:
            m = 10 + 90 * len(t) * documents // total
            score = 0
            for term in terms & set(t):
                w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[term] + 1)))
                tf = t.count(term)
                score += w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda x: x[:3])
        out += [(item, n, x[3], -x[0]) for n, x in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, ranking=lexical.Ranking()):
    rows = lexical.search(docs, items, ranking)
    assert rows.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in rows.collect()), key=str)


SETTINGS = [
    lexical.Ranking(),
    lexical.Ranking(segment_bytes=2000, fan_in=2, block_terms=40),
    lexical.Ranking(segment_bytes=50_000, vocabulary=0, k=3),
]


@pytest.mark.parametrize("ranking", SETTINGS)
def test_best_documents_equal_brute_force(spark, documents, small, ranking):
    items = spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text")
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    asked = [(r["item_id"], r["text"]) for r in items.collect()]
    assert found(documents, items, ranking) == best_by_hand(docs, asked, ranking.k)


@pytest.mark.parametrize("ranking", SETTINGS)
def test_odd_documents_and_items(spark, odd_documents, ranking):
    asked = [
        (1, "one TWO two words"), (1, "xyz c"), (None, "one"), (None, "Words!"), (2, None), (3, ""),
        (4, "not anywhere"), (5, "x" * 100_000), (6, "d　d 123"), (1, "one TWO two words"),
    ]
    items = spark.createDataFrame(asked, "item_id bigint, text string").withColumn("term", F.lit(1))
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert found(odd_documents, items, ranking) == best_by_hand(docs, asked, ranking.k)
    assert found(odd_documents.limit(0), items, ranking) == []
    assert found(odd_documents, items.limit(0), ranking) == []


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from("abcdef"), max_size=12), min_size=1, max_size=40),
    st.lists(st.sampled_from("abcdefz"), min_size=1, max_size=5, unique=True),
    st.integers(1, 6),
)
def test_intervals_find_what_a_full_look_finds(docs, query, k):
    """Any lists, any weights, ties everywhere: equal to scoring every document."""
    letters = sorted({c for d in docs for c in d})
    if not letters:
        return
    postings = [[(i, d.count(c)) for i, d in enumerate(docs) if c in d] for c in letters]
    starts = np.cumsum([0] + [len(p) for p in postings])
    lists = lexical.Lists(
        np.array([ord(c) for c in letters], np.uint64), starts,
        np.array([i for p in postings for i, _ in p]), np.array([n for p in postings for _, n in p]),
        len(docs),
    )
    weights = {c: 1 + ord(c) % 3 for c in query}
    numbers, scores = lexical.best_documents(
        lists, np.array(sorted(map(ord, query)), np.uint64),
        np.array([weights[chr(c)] for c in sorted(map(ord, query))]), k,
    )
    full = sorted((-sum(weights[c] * d.count(c) for c in query), i) for i, d in enumerate(docs))
    assert [(-s, i) for i, s in zip(numbers, scores, strict=True)] == [x for x in full if x[0]][:k]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=70), st.data())
def test_sparse_tables_tell_the_largest_impact(values, data):
    lists = lexical.Lists(
        np.array([5], np.uint64), np.array([0, len(values)]), np.arange(len(values)),
        np.array(values), len(values),
    )
    low = data.draw(st.integers(0, len(values)))
    high = data.draw(st.integers(low, len(values)))
    place, most = lists.best(np.array([[low]]), np.array([[high]]))
    assert most[0, 0] == max(values[low:high], default=0)
    assert low == high or values[place[0, 0]] == most[0, 0] and low <= place[0, 0] < high


def test_bounds_spare_most_documents():
    """One document of many holds the rare term: few intervals are ever split."""
    n = 5000
    docs = np.concatenate([np.arange(n), [1234]])
    impacts = np.concatenate([np.ones(n, np.int64), [100]])
    lists = lexical.Lists(np.array([1, 2], np.uint64), np.array([0, n, n + 1]), docs, impacts, n)
    seen = []
    plain = lists.places
    lists.places = lambda own, low: seen.append(len(low)) or plain(own, low)
    numbers, scores = lexical.best_documents(lists, np.array([1, 2], np.uint64), np.array([1, 1]), 1)
    assert (numbers.tolist(), scores.tolist()) == ([1234], [101])
    assert sum(seen) <= 4


# --- Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_by_hand(leaves):
    """Root, and each leaf's siblings by level as (left, right)."""
    groups, paths = [[i] for i in range(len(leaves))], [[] for _ in leaves]
    nodes = list(leaves)
    while len(nodes) > 1:
        higher, members = [], []
        for low in range(0, len(nodes), 8):
            run = nodes[low : low + 8]
            for j in range(len(run)):
                for leaf in groups[low + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            higher.append(sha(*run))
            members.append([leaf for g in groups[low : low + 8] for leaf in g])
        nodes, groups = higher, members
    return nodes[0], paths


def manifest_by_hand(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    parts = {}
    for lang in langs:
        own = sorted(
            (r for r in rows if r["lang"] == lang),
            key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_by_hand(r, r["text"])),
        )
        parts[lang] = own, *tree_by_hand([leaf_by_hand(r, r["text"]) for r in own])
    if not parts:
        return []
    root, tops = tree_by_hand([parts[x][1] for x in langs])
    out = []
    for lang, top in zip(langs, tops, strict=True):
        own, subroot, paths = parts[lang]
        for r, path in zip(own, paths, strict=True):
            path = path + top
            i, text = r["doc_id"], r["text"]
            if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            folded = leaf_by_hand(r, text)
            for left, right in path:
                folded = sha(left, folded, right)
            proof = sha(*[x for side in path for x in side])
            out.append((i, leaf_by_hand(r, r["text"]), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def checked(frame):
    rows = merkle.verified_documents(frame).collect()
    assert sorted(map(tuple, rows), key=str) == manifest_by_hand(frame.collect())
    return rows


def test_manifest_of_odd_documents(odd_documents):
    more = odd_documents.withColumns({c: F.lit(1) for c in ("first", "lo", "path", "kids", "leaf", "at")})
    checked(more)
    assert merkle.verified_documents(more.limit(0)).collect() == []


@pytest.mark.parametrize("sizes", [[1], [8], [9], [65, 1, 2], [1] * 70])
def test_manifest_of_trees_of_many_shapes(spark, sizes):
    rows = [
        (100 * g + i, f"Text {i} é" if i % 5 else None, f"l{g}" if g else None, "s", i)
        for g, n in enumerate(sizes) for i in range(n)
    ]
    found = checked(spark.createDataFrame(rows, DOCS))
    assert {r["verified"] for r in found} <= {True, False} and any(r["verified"] for r in found)


def test_intervals_nest(spark, documents):
    rows = documents.select("doc_id", "lang", merkle.leaf_digest().alias("leaf"))
    made = merkle.manifest(rows, "lang", ["doc_id"])
    nodes = [tuple(r) for r in made.nodes.select("level", "first", "n", "lo", "hi").collect()]
    assert sorted(x[3] for x in nodes if x[0] == 0) == list(range(rows.count()))
    for level, first, n, lo, hi in nodes:
        over = [x for x in nodes if x[0] == level + 1 and x[3] <= lo and hi <= x[4]]
        assert len(over) == (n > 8**level)
        assert first <= lo < hi <= first + n and hi - lo <= 8**level
    assert made.subroots.count() == documents.select("lang").distinct().count()


# --- sharding


def cells_by_hand(points, shards):
    """The tree over points (place, copies, row, size) by sorting every cell."""
    dims = len(points[0][0])
    whole = [max(p[0][d] for p in points) - min(p[0][d] for p in points) for d in range(dims)]

    def cut(own, first, count):
        if count == 1 or not own:
            return {p[2]: first for p in own}
        wide = []
        for d in range(dims):
            extent = max(p[0][d] for p in own) - min(p[0][d] for p in own)
            wide.append(extent / whole[d] if whole[d] else 0.0)
        d = wide.index(max(wide))
        own = sorted(own, key=lambda p: (p[0][d], p[1], p[2]))
        ends = np.cumsum([p[3] for p in own])
        goal = int(ends[-1]) * (count // 2) / count
        n = int(np.searchsorted(ends, goal))
        before = int(ends[n - 1]) if n else 0
        if abs(ends[n] - goal) < abs(goal - before):
            n += 1
        return cut(own[:n], first, count // 2) | cut(own[n:], first + count // 2, count - count // 2)

    return cut(points, 0, shards)


@pytest.mark.parametrize("shards", [1, 2, 7, 24])
def test_cuts_equal_those_of_sorted_cells(spark, documents, shards):
    tree = sharding.Tree(shards=shards, near=0.0, whole=0.0, cells=64)
    at = sharding.points(documents, tree).persist()
    rows = [(r["place"], r["copies"], r["row_id"], r["size"]) for r in at.collect()]
    found = {r["row_id"]: r["shard"] for r in sharding.with_shards(at, tree).collect()}
    assert found == cells_by_hand(rows, shards)
    at.unpersist()


def shard_rows(frame, tree=sharding.Tree()):
    rows = sharding.kd_shards(frame, tree).collect()
    texts = sorted((r["doc_id"], r["text"]) for r in frame.fillna({"doc_id": -9}).collect() if r["text"] is not None)
    told = {(i, zlib.crc32(t.encode()), len(t.encode()) + 8) for i, t in texts}
    assert told <= {(r["doc_id"] if r["doc_id"] is not None else -9, r["text_crc32"], r["size"]) for r in rows}
    assert len(rows) == frame.count()
    by_shard = {}
    for r in rows:
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        by_shard.setdefault(r["shard"], []).append(r)
    for own in by_shard.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return by_shard


def test_shards_of_odd_documents(odd_documents):
    more = odd_documents.withColumns({c: F.lit(1) for c in ("size", "node", "part", "own", "place", "at")})
    by_shard = shard_rows(more)
    assert set(by_shard) <= set(range(24))
    empty = [r for own in by_shard.values() for r in own if r["doc_id"] in (1, 2)]
    assert [(r["size"], r["text_crc32"]) for r in empty] == [(8, 0), (8, 0)]
    assert sharding.kd_shards(more.limit(0)).collect() == []


def test_shards_are_near_equal_and_copies_stay_together(spark):
    """A text that is a third of all rows is cut; the copies of others stay in one shard."""
    docs = spark.range(6000).selectExpr(
        "id AS doc_id",
        """CASE WHEN id % 3 = 0 THEN repeat('copy ', 40)
             WHEN id % 3 = 1 THEN concat('few ', id div 12) ELSE repeat(concat('own ', id, ' '), id % 20) END AS text""",
        "concat('s', id % 7) AS source", "CASE WHEN id % 2 = 0 THEN 'en' END AS lang",
    )
    by_shard = shard_rows(docs, sharding.Tree(whole=1e-2))
    sizes = [sum(r["size"] for r in own) for own in by_shard.values()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) < 0.06 * sum(sizes) / 24
    places = {}
    for shard, own in by_shard.items():
        for r in own:
            places.setdefault(r["text_crc32"], set()).add(shard)
    assert [len(p) for p in places.values() if len(p) > 1] == [max(map(len, places.values()))]


def test_rows_that_are_equal_in_everything_are_cut_too(spark):
    docs = spark.range(480).selectExpr("1L AS doc_id", "'same' AS text", "'s' AS source", "'en' AS lang")
    by_shard = shard_rows(docs)
    assert [len(by_shard[s]) for s in range(24)] == [20] * 24


def test_target_bytes_decide_how_many_shards(spark, documents):
    by_shard = shard_rows(documents, sharding.Tree(target_bytes=100_000))
    total = sum(r["size"] for own in by_shard.values() for r in own)
    assert len(by_shard) == -(-total // 100_000)


def test_the_sharding_query_is_native(spark, small):
    plan = QUERIES["op13_kd_sharding"](spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)
