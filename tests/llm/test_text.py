from __future__ import annotations

import collections
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from contract.check import difference

from swishline.llm import language, ngram_join, quality, words
from swishline.llm.queries import ORACLE_SQL, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(count=250):
    rng = random.Random(1)
    made = [
        "".join(rng.choice("ab é\n #x\t") for _ in range(rng.choice([3, 20, 200])))
        for _ in range(count)
    ]
    fixed = [None, "", " ", "a", "\n", "a\n", "a b c a b c", "x\nx\nx \nx", "\n\n\na\n\na"]
    return fixed + made


def measures(text):
    text = text or ""
    found = WORD.findall(text)
    counts = collections.Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    covered = {
        i + k for i in range(len(found) - 2) if counts[tuple(found[i : i + 3])] > 1 for k in range(3)
    }
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    symbols = sum(text.count(s) for s in "#*$%&|<>")
    return len(found), sum(map(len, found)), symbols, again, len(covered)


@pytest.mark.parametrize("chunk", [1 << 20, 64])
def test_measures_equal_plain_python(monkeypatch, chunk):
    monkeypatch.setattr(words, "CHUNK", chunk)
    rows = texts()
    found = quality._measures(pa.array(rows, pa.string()))
    for i, text in enumerate(rows):
        assert tuple(int(found[m][i]) for m in quality.MEASURES) == measures(text)


def test_a_failing_host_loses_its_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "short", "bad") for i in range(95)] + [(100 + i, f"{good} {i}", "bad") for i in range(5)]
    rows += [(1000 + i, f"{good} {i}", "good") for i in range(100)] + [(2000, f"{good} x", None)]
    rows += [(3000, "short", "few"), (3001, f"{good} y", "few"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r["doc_id"] for r in quality.accepted(docs).collect()}
    assert kept == {1000 + i for i in range(100)} | {2000, 3001}
    verdicts = quality.quality_verdicts(docs)
    assert verdicts.count() == len(rows)
    assert {r["doc_id"] for r in verdicts.where("kept").collect()} == kept
    assert quality.quality_verdicts(docs.limit(0)).collect() == []


def hosts_that_differ():
    """19 hosts of which a tenth fails, one of which half does, and two with few documents."""
    good = " ".join(f"w{i}" for i in range(60))
    rows = []
    for host in range(20):
        for i in range(100):
            fails = i % 2 == 0 if host == 7 else i % 10 == 0
            rows.append((1000 * host + i, "short" if fails else f"{good} {i}", f"h{host}"))
    rows += [(90_000 + i, "short" if i else f"{good} a", "few") for i in range(4)]
    return rows + [(99_000, f"{good} b", None)]


def test_a_host_is_judged_against_all_others(spark, tmp_path):
    rows = hosts_that_differ()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    verdicts = quality.quality_verdicts(docs).collect()
    lost = {r["host"] for r in verdicts if not r["kept"] and not r["base_failed"]}
    assert lost == {"h7"}
    assert {r["doc_id"] for r in verdicts if r["kept"]} >= {90_000, 99_000}
    # the same by the query and its SQL, with documents on both sides of the verdict
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')"
    )
    found = QUERIES["op7_quality_rules"](spark, str(tmp_path))
    assert difference(found, connection, ORACLE_SQL["op7_quality_rules"]) is None


def test_hosts_that_all_fail_alike_lose_nothing_more(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "short" if i % 3 == 0 else f"{good} {i}", f"h{i % 7}") for i in range(2100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert quality.accepted(docs).count() == 1400


def test_quality_handles_odd_rows(odd_documents):
    assert quality.quality_verdicts(odd_documents).count() == odd_documents.count()
    kept = quality.accepted(odd_documents, quality.Rules(min_words=0, max_repeat_percent=100))
    assert kept.columns == odd_documents.columns
    assert kept.count() == odd_documents.count()


def grams(docs):
    sets = {}
    for doc_id, text in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        found = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        sets[doc_id] = found or ({tuple(w)} if w else set())
    return sets


def linked(docs):
    """Set sizes and components by brute force."""
    sets = grams(docs)
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(sets[k]), root(k)) for k in keys}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 40))) for _ in range(25)]
    rows = []
    for i in range(300):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            w[rng.randrange(len(w))] = rng.choice("abcdefgHIJ")
        rows.append((i * 3 % 1201, " ".join(w)))
    # a star of copies that are far from each other, and a chain
    core = [f"c{i}" for i in range(150)]
    for k in range(40):
        own = list(core)
        for j in range(3):
            own[(k * 3 + j * 37) % 150] = f"o{k}{j}"
        rows.append((2000 + k, " ".join(own)))
    rows.append((2100, " ".join(core)))
    rows += [(2200 + k, " ".join(f"d{i}" for i in range(k * 4, k * 4 + 100))) for k in range(12)]
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "a b"), (5004, "A  B"), (5005, "b a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = ngram_join.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == linked(rows)

    sets = grams(rows)
    first = {}
    for k in sorted(sets):
        first.setdefault(frozenset(sets[k]), k)
    assert {r["doc_id"]: r["class_id"] for r in found} == {
        k: first[frozenset(v)] if v else k for k, v in sets.items()
    }
    pairs = {(r["a"], r["b"]) for r in ngram_join.similar_pairs(docs).collect()}
    keys = sorted(k for v, k in first.items() if v)
    assert pairs == {
        (a, b)
        for i, a in enumerate(keys)
        for b in keys[i + 1 :]
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }


def test_a_common_passage_over_many_components(spark, monkeypatch):
    """One passage, and so its n-grams, in 90 groups of short texts that differ otherwise."""
    monkeypatch.setattr(ngram_join, "HOT_DOCS", 7)
    passage = " ".join(f"p{i}" for i in range(9))
    rng, rows = random.Random(11), []
    for group in range(90):
        own = [f"g{group}w{i}" for i in range(rng.choice([4, 20, 36]))]
        for copy in range(rng.choice([1, 2, 3])):
            tail = own[: len(own) - copy]
            rows.append((10 * group + copy, f"{passage} {' '.join(tail)}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = ngram_join.similar(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == linked(rows)
    sets = grams(rows)
    expected = {
        a: sum(a != b and 100 * len(x & y) >= 80 * len(x | y) for b, y in sets.items())
        for a, x in sets.items()
    }
    assert {r["doc_id"]: r["n_links"] for r in found} == expected
    assert len({r["component_id"] for r in found}) > 60
    both = {(a, b) for r in ngram_join.similar_pairs(docs).collect() for a, b in [(r["a"], r["b"])]}
    assert 2 * len(both) == sum(expected.values())


@pytest.mark.parametrize("block_grams", [1 << 15, 300])
def test_every_link_is_counted(spark, monkeypatch, block_grams):
    """Near copies with different texts, of which components alone need few links."""
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", block_grams)
    monkeypatch.setattr(ngram_join, "COLUMNS", 64)
    rng = random.Random(7)
    core = [f"c{i}" for i in range(100)]
    rows = [(9, " ".join(core)), (10, " ".join(core)), (10, " ".join(core)), (None, " ".join(core))]
    for k in range(60):
        own = list(core)
        for j in range(rng.choice([1, 2, 3])):
            own[rng.randrange(100)] = f"o{k}{j}"
        rows += [(100 + 3 * k, " ".join(own))] * 1 + [(101 + 3 * k, " ".join(own))] * (k % 3 == 0)
    rows += [(500, "alone in the world and in no other place"), (501, None), (502, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = grams([r for r in rows if r[0] is not None])
    expected = {
        a: sum(
            a != b and len(x & y) > 0 and 100 * len(x & y) >= 80 * len(x | y)
            for b, y in sets.items()
        )
        for a, x in sets.items()
    }
    found = ngram_join.similar(docs).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["n_links"] for r in found if r["doc_id"] is not None} == expected
    assert [r["n_links"] for r in found if r["doc_id"] is None] == [expected[9] + 1]
    assert max(expected.values()) > 20 and expected[500] == 0


def test_near_duplicates_handle_odd_rows(odd_documents):
    found = ngram_join.near_duplicates(odd_documents).collect()
    assert len(found) == odd_documents.count()
    by_id = {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None}
    assert by_id[4] == 4 and by_id[1] == 1
    kept = ngram_join.representatives(odd_documents)
    assert kept.columns == odd_documents.columns
    assert kept.count() == odd_documents.count()
    assert ngram_join.near_duplicates(odd_documents.limit(0)).collect() == []
    assert ngram_join.similar(odd_documents.limit(0)).collect() == []
    assert ngram_join.similar(odd_documents).count() == odd_documents.count()


def test_gradients_equal_differences():
    from swishline.llm import byte_gru

    rng = np.random.default_rng(0)
    w = byte_gru.new_weights(3, 2, rng)
    x = rng.integers(0, 256, (5, 4)).astype(np.uint8)
    live = np.ones((5, 4), np.float32)
    live[3:, 1] = 0
    label = np.array([0, 1, 1, 0])
    _, grads = byte_gru.gradients(w, x, live, label)
    for name, grad in grads.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        losses = []
        for step in (1e-2, -1e-2):
            moved = {k: v.copy() for k, v in w.items()}
            moved[name][at] += step
            losses.append(byte_gru.gradients(moved, x, live, label)[0])
        assert abs((losses[0] - losses[1]) / 2e-2 - grad[at]) < 2e-3


def test_pooled_probabilities_count_every_byte_once():
    from swishline.llm import byte_gru

    rng = np.random.default_rng(0)
    w = byte_gru.new_weights(4, 3, rng)
    model = language.Model(["a", "b", "c"], w, 16)
    for size in (1, 5, 16, 17, 40):
        raw = rng.integers(0, 256, size).astype(np.uint8)
        found = language._pooled(model, raw, np.array([0, size]))[0]
        assert abs(found.sum() - 1) < 1e-4


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    rows = found.collect()
    assert len(rows) > 250
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_handles_odd_rows(odd_documents):
    few = language.Training(steps=3)
    found = language.identify(odd_documents, few).collect()
    assert len(found) == odd_documents.count()
    und = sorted(r["doc_id"] for r in found if r["lang_pred"] == "und")
    assert und == [1, 2, 3, 7]
    kept = language.accepted(odd_documents, min_score=0, t=few)
    assert kept.columns == odd_documents.columns
    assert kept.count() == odd_documents.count() - 4
    assert language.identify(odd_documents.limit(0), few).collect() == []
    unlabelled = odd_documents.where("lang IS NULL")
    assert {r["lang_pred"] for r in language.identify(unlabelled, few).collect()} == {"und"}
