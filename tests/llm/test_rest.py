from __future__ import annotations

import html
import re
import time
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from contract.check import difference, duckdb_over
from hypothesis import given, settings
from hypothesis import strategies as st

from swishline.llm import chat, html_wrappers, mixing, topk
from swishline.llm.html_tree import parse
from swishline.llm.html_wrappers import _merged, extract, main_texts, merged, of_page, rule
from swishline.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, small, name):
    assert difference(QUERIES[name](spark, small), duckdb_over(small), ORACLE_SQL[name]) is None


# --- pages


def article(page):
    """The text of pages whose article holds paragraphs and headings only."""
    inner = re.sub(r"<!--.*?-->", "", re.search(r"<article>(.*?)</article>", page, re.S)[1], flags=re.S)
    parts = re.split(r"</?(?:p|h1|h2|li|ul)\b[^>]*>", inner.replace("<br>", " "))
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
    return "\n".join(p for p in parts if p)


def test_main_texts_of_all_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    expected = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    found = main_texts(pages).collect()
    assert {r["page_id"]: r["text"] for r in found} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_pages_without_an_article_and_odd_pages(spark):
    def page(i, own):
        return (
            f"<body><div class=top>Shop of things</div><div class='box'><div class=text>{own}</div>"
            f"<div class=rights>All rights reserved by the shop</div></div>"
            f"<div class='comments'><p>I like number {i}</p></div></body>"
        )

    own = [f"<h1>Title {i}</h1>" + f"<p>Own text &amp; words {i}</p>" * (i + 1) for i in range(4)]
    rows = [(i, "http://h.example/" + str(i), page(i, t), "x") for i, t in enumerate(own)]
    rows += [(10, None, None, "x"), (11, "no url", "", "x"), (12, "http://h.example/q", "bare <b>text", "x")]
    rows += [(13, "http://deep.example", "<div>" * 3000 + "<p>a<p>b", "x"), (None, "http://h.example", None, "x")]
    rows += [rows[0], (14, "http://b.example", "<p>5 < 6 <!-- open", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    found = [(r["page_id"], r["text"]) for r in main_texts(pages).collect()]
    expected = {
        i: f"Title {i}\n" + "\n".join([f"Own text & words {i}"] * (i + 1)) for i in range(4)
    } | {10: "", 11: "", 12: "bare text", 13: "a\nb", None: "", 14: "5 < 6"}
    assert sorted(found, key=str) == sorted([*expected.items(), (0, expected[0])], key=str)
    assert main_texts(pages.limit(0)).collect() == []


def test_inline_elements_that_are_skipped():
    page = (
        "<article><h1>T</h1><img class=ad src=x><p>a <span class='ad'>buy <span>now</span> or</span>"
        " b <a class=x>link</a><input class=search> c</p><p>d</p></article>"
    )
    assert extract(page, None) == "T\na b link c\nd"


def test_elements_that_close_themselves_or_are_never_closed():
    page = "<article><p>a <svg class=icon/> b <video src=x> c</p><svg><text>no</text></svg><p>d</article>"
    assert extract(page, None) == "a b c\nd"
    assert extract("<article><p>a<svg/>b</p><p>c <svg><path></svg>d</p></article>", None) == "ab\nc d"
    assert extract("<article><p>a</p><script>never closed <p>b", None) == "a"


def test_layouts_without_landmarks():
    body = "<h1>{0} title</h1>" + "<p>{0} words of the text itself</p>" * 3
    layouts = [
        "<div id=header>Site</div><div id=content>%s<div class=share-buttons>share</div></div>"
        "<div class=comments><p>a comment of some length</p></div><div id=footer>end</div>" % body,
        "<table><tr><td class=l>links<td class=c>%s<td class=r>more</table>" % body,
        "<section class=post><h1>{0} title</h1><div class=t>%s</div></section>"
        "<section class=related><p>other things to read</p></section>" % body[18:],
        "<main><header><h1>{0} title</h1></header>%s<form><p>mail</form></main>" % body[18:],
    ]
    for layout in layouts:
        pages = ["<body>" + layout.format(k) for k in ("first", "second", "third", "fourth")]
        how = rule(merged([of_page(parse(p)) for p in pages]))
        for k, page in zip(("first", "second", "third", "fourth"), pages, strict=True):
            expected = "\n".join([f"{k} title", *[f"{k} words of the text itself"] * 3])
            assert extract(page, how) == expected


def texts_of_host(pages):
    how = rule(merged([of_page(parse(p)) for p in pages]))
    return [extract(p, how) for p in pages]


def test_fixed_paragraphs_are_dropped_by_place_and_text():
    layout = (
        "<body><div class=content><p>By our staff</p><h1>{0} title</h1><p>{0} words of the text</p>"
        "<p>{1}</p><hr><p>All rights reserved</p></div>"
    )
    last = ["more first", "By our staff", "more third", "All rights reserved", "more fifth"]
    pages = [layout.format(f"page{i}", own) for i, own in enumerate(last)]
    assert texts_of_host(pages) == [
        f"page{i} title\npage{i} words of the text\n{own}" for i, own in enumerate(last)
    ]


def test_what_a_few_pages_of_a_host_share_is_their_own():
    own = "<h1>title {0}</h1><p>words of page {0}</p><p>more of page {0}</p>"
    shared = "<blockquote>a passage that three pages share</blockquote>"
    pages = [
        "<body><div class=content>" + own.format(i) + (shared if i < 3 else "") + "</div>"
        for i in range(30)
    ]
    for i, text in enumerate(texts_of_host(pages)):
        expected = [f"title {i}", f"words of page {i}", f"more of page {i}"]
        assert text.split("\n") == expected + ["a passage that three pages share"] * (i < 3)


def test_wrappers_find_repeats_options_and_slots():
    first = of_page(parse("<body><p>same</p><ul><li>a<li>b<li>c</ul><h2>x</h2>"))
    second = of_page(parse("<body><p>same</p><h2>y</h2><div>new</div>"))
    body = _merged(first, second)["k"][0]
    assert [(k["l"], k["o"], k["r"], k["f"]) for k in body["k"]] == [
        ("p", False, False, "same"),
        ("ul", True, False, ""),
        ("h2", False, False, None),
        ("div", True, False, "new"),
    ]
    assert [(k["l"], k["r"]) for k in body["k"][1]["k"]] == [("li", True)]
    grouped = of_page(parse("<body>" + "<h2>t</h2><p>u</p>" * 3))["k"][0]["k"]
    assert [(k["l"], k["r"]) for k in grouped] == [("(h2 p)", True)]
    once = of_page(parse("<body><h2>t</h2><p>u</p>"))
    both = merged([once, of_page(parse("<body>" + "<h2>t</h2><p>u</p>" * 3))])["k"][0]["k"]
    assert [(k["l"], k["r"], k["o"]) for k in both] == [("(h2 p)", True, False)]


def test_text_after_and_within_deep_nests_is_kept():
    for depth in (250, 20_000):
        page = (
            "<div><article><p>first</p>" + "<div>" * depth + "<p>inner</p><div class=ad>buy</div>"
            + "</div>" * depth + "<p>after the nest</p></article></div><footer>end</footer>"
        )
        assert extract(page, None) == "first\ninner\nafter the nest"
        assert texts_of_host([page] * 3) == ["first\ninner\nafter the nest"] * 3


def test_names_do_not_drop_headings_paragraphs_or_whole_pages():
    page = (
        "<body class='home has-sidebar'><article class='post social'><h1 class='post header'>T</h1>"
        "<p class=social>a</p><section id=tags><p>b</p></section><div class=share-buttons>no</div>"
        "<div class='text no-comments'><p class=notice>c</p></div><div class='post header'>by x<h2>U</h2></div>"
        "</article></body>"
    )
    assert extract(page, None) == "T\na\nb\nc\nU"
    assert extract("<main><div class=widget><p>all there is</p></div></main>", None) == "all there is"


def test_the_wrapper_drops_template_text_of_marked_items():
    """Every page alone keeps what only the host's other pages tell apart."""
    layout = (
        "<article><p>By our staff</p><h1>{0} title</h1><p>{0} words of the text itself</p>"
        "<p>{0} more words, and some of its own</p><p>Write to us if you find a mistake</p></article>"
    )
    pages = [layout.format(f"page{i}") for i in range(8)]
    for i, text in enumerate(texts_of_host(pages)):
        own = [f"page{i} title", f"page{i} words of the text itself", f"page{i} more words, and some of its own"]
        assert text.split("\n") == own
        assert extract(pages[i], None).split("\n") == ["By our staff", *own, "Write to us if you find a mistake"]


def test_wrappers_merge_in_bounded_groups(spark, monkeypatch):
    """The wrapper of a host decides over all pages, from however many tasks they come."""
    layout = "<article><p>Fixed line</p><h1>{0} title</h1><p>{0} words of the text itself</p></article>"
    rows = [(i, f"http://h.example/{i}", layout.format(f"page{i}")) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(24)
    monkeypatch.setattr(html_wrappers, "MERGED_AT_ONCE", 4)
    found = {r["page_id"]: r["text"] for r in main_texts(pages).collect()}
    assert found == {i: f"page{i} title\npage{i} words of the text itself" for i in range(60)}


def test_copies_of_a_page_are_no_template():
    page = "<article><h1>same title</h1><p>same text</p><p>more of it</p></article>"
    near = page.replace("more of it", "a little else here")
    assert texts_of_host([page] * 9) == ["same title\nsame text\nmore of it"] * 9
    assert texts_of_host([page] * 4 + [near] * 4)[-1] == "same title\nsame text\na little else here"


@settings(deadline=None, max_examples=40)
@given(
    st.sampled_from(["article", "main", "div class=content", "section id=text"]),
    st.lists(st.tuples(st.booleans(), st.sampled_from(["p", "h2", "blockquote", "div"])), min_size=2, max_size=7),
    st.integers(6, 12),
)
def test_hosts_made_of_own_and_fixed_blocks(tag, blocks, count):
    """The plain version: what a page is made of, less what all pages are made of. Fixed
    blocks stand first or last, as templates have them."""
    blocks = [*blocks, (True, "p"), (True, "p")]
    half = len(blocks) // 2
    fixed = [(f"fixed {n} of the host", t) for n, (own, t) in enumerate(blocks) if not own]

    def page(i):
        own = [(f"page {i} has words of its own in block number {n}", t) for n, (o, t) in enumerate(blocks) if o]
        rows = [*fixed[:half], ("title of page %d" % i, "h1"), *own, *fixed[half:]]
        inner = "".join(f"<{t}>{text}</{t}>" for text, t in rows)
        body = f"<nav>home</nav><{tag}>{inner}</{tag.split()[0]}><footer>end</footer>"
        return f"<body>{body}</body>", [text for text, _ in rows if "fixed" not in text]

    pages = [page(i) for i in range(count)]
    for found, (_, want) in zip(texts_of_host([p for p, _ in pages]), pages, strict=True):
        assert found.split("\n") == want


@settings(deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=30), st.lists(st.sampled_from("abcd"), max_size=30))
def test_alignments_are_longest(a, b):
    found = html_wrappers.common(a, b)
    assert all(a[i] == b[j] for i, j in found)
    assert all(x < y and u < v for (x, u), (y, v) in zip(found, found[1:], strict=False))
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert len(found) == table[-1][-1]


def test_very_long_lists_are_aligned_exactly():
    first = "<ul>" + "".join(f"<li class=k{chr(97 + i % 7)}>x</li><p>y" for i in range(1500)) + "</ul>"
    second = first.replace("<li class=ka>x</li>", "", 1)
    whole = _merged(of_page(parse(first)), of_page(parse(second)))
    assert html_wrappers.decoded(html_wrappers.encoded(whole)) == whole


@settings(deadline=None)
@given(st.text(st.sampled_from("<>/pdivarticleh1 \"'=!-&;ab"), max_size=200))
def test_any_page_can_be_read(page):
    assert isinstance(extract(page, None), str)
    rule(of_page(parse(page)))


# --- chats

TURN = "conv_id bigint, turn bigint, role string, text string"


@settings(max_examples=6, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from([1, 2, None]),
            st.sampled_from([0, 1, 2, None]),
            st.sampled_from(["user", "assistant", "system", "a\nb", "", None]),
            st.one_of(st.none(), st.text(st.sampled_from("a&<|;\\lt\nim_end>é"), max_size=12), st.just("<|im_end|>\n")),
        ),
        max_size=8,
    )
)
def test_chats_round_trip(spark, rows):
    import hashlib

    found = {r["conv_id"]: r for r in chat.read_back(chat.examples(spark.createDataFrame(rows, TURN))).collect()}
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert found.keys() == groups.keys()
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        got = found[conv]
        assert got["n_turns"] == len(turns)
        assert got["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got["loss_chars"] == len(loss)
        assert got["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_each_assistant_turn_is_an_example(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "r"), (1, 2, "user", "s"), (1, 3, "assistant", "t")]
    found = chat.examples(spark.createDataFrame(rows, TURN)).orderBy("example").collect()
    assert [r["formatted"][r["loss_start"] : r["loss_end"]] for r in found] == ["r", "t"]
    assert found[1]["formatted"].startswith(found[0]["formatted"])


def test_the_chat_query_is_native(spark, small):
    plan = QUERIES["op5_chat_formatting"](spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- mixing


def fluid_shares(blocks, weights, slots):
    """By number of slots, how much of each source has flowed: phase by phase, in fractions."""
    had, out = {s: Fraction(0) for s in blocks}, []
    for _ in range(slots + 1):
        out.append(dict(had))
        time = Fraction(1)
        while time:
            active = {s: Fraction(weights[s]) for s in blocks if had[s] < blocks[s]}
            if not active:
                break
            total = sum(active.values())
            step = min([time, *((blocks[s] - had[s]) * total / w for s, w in active.items())])
            for s, w in active.items():
                had[s] += step * w / total
            time -= step
    return out


def worst_deviation(blocks, mix, weights):
    """The largest difference between blocks dealt and blocks flowed, over all slots."""
    order = list(mixing.schedule(blocks, mix))
    assert sorted(order) == sorted((s, i) for s, n in blocks.items() for i in range(n))
    shares, met, worst = fluid_shares(blocks, weights, len(order)), Counter(), Fraction(0)
    for n, (s, i) in enumerate(order, 1):
        assert met[s] == i
        met[s] += 1
        worst = max([worst, *(abs(met[x] - shares[n][x]) for x in blocks)])
    return worst


@settings(deadline=None, max_examples=60)
@given(
    st.dictionaries(st.sampled_from("abcdefgh"), st.integers(1, 30), min_size=1),
    st.lists(st.one_of(st.integers(1, 50), st.floats(0.001, 9)), min_size=8, max_size=8),
)
def test_no_source_is_a_block_off_the_fluid_in_any_phase(blocks, numbers):
    weights = dict(zip("abcdefgh", numbers, strict=True))
    assert worst_deviation(blocks, mixing.Mix(weights), weights) < 1
    roots = {s: n**0.5 for s, n in blocks.items()}
    assert worst_deviation(blocks, mixing.Mix(), roots) < 1


def test_small_and_large_weights_stay_within_a_block():
    blocks = {"big": 200} | {f"s{i}": 2 for i in range(100)}
    weights = {"big": 0.5} | {f"s{i}": 0.005 for i in range(100)}
    assert worst_deviation(blocks, mixing.Mix(weights), weights) < 1
    rare = {"a": 0.7, "b": 0.2999, "c": 0.0001}
    assert worst_deviation({"a": 700, "b": 300, "c": 2}, mixing.Mix(rare), rare) < 1


def test_sources_without_a_weight_come_last():
    order = [s for s, _ in mixing.schedule({"a": 3, "b": 2, "c": 4}, mixing.Mix({"a": 1.0, "c": 0}))]
    assert order[:3] == ["a"] * 3 and Counter(order[3:]) == {"b": 2, "c": 4}


def test_time_grows_in_line_with_sources():
    """100,000 sources that all run out at different times, in one pass."""

    def seconds(count):
        begin = time.perf_counter()
        order = sum(1 for _ in mixing.schedule({f"s{i}": 1 + i % 3 for i in range(count)}, mixing.Mix()))
        assert order == sum(1 + i % 3 for i in range(count))
        return time.perf_counter() - begin

    seconds(1000)
    few, many = seconds(10_000), seconds(100_000)
    assert many < 30 * few


def test_blocks_grow_with_the_documents(spark):
    docs = spark.range(900).selectExpr("id AS doc_id", "'t' AS text", "'s' AS source")
    rows = mixing.mixed(docs, mixing.Mix(block=2, most_blocks=10)).collect()
    assert Counter(r["mix_slot"] for r in rows) == dict.fromkeys(range(10), 90)


def test_mixed_follows_the_schedule(spark):
    docs = spark.range(900).selectExpr(
        "id AS doc_id", "'t' AS text", "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS source"
    )
    mix = mixing.Mix({"a": 0.3, "b": 0.7}, block=2)
    found = {
        (r["source_key"], r["mix_block"]): r["mix_slot"] for r in mixing.mixed(docs, mix).collect()
    }
    order = mixing.schedule({"a": 150, "b": 300}, mix)
    assert found == {block: slot for slot, block in enumerate(order)}


def test_mixing_keeps_every_row(spark, odd_documents):
    mix = mixing.Mix({"a": 3, "b": 1}, block=2)
    rows = mixing.mixed(odd_documents, mix).collect()
    assert len(rows) == odd_documents.count()
    assert len({(r["mix_slot"], r["mix_place"]) for r in rows}) == len(rows)
    kept = mixing.in_mix_order(odd_documents, mix)
    assert kept.columns == odd_documents.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, odd_documents.collect()))
    assert mixing.mixed(odd_documents.limit(0)).collect() == []


# --- vectors


def best(rows, k):
    whole = [
        (i, np.floor(256 * np.array(v, float)).astype(np.int64))
        for i, v in rows
        if v is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = {}
    for i, v in whole:
        if i % 50 == 0:
            scored = sorted((-int(v @ w), j) for j, w in whole if j != i)[:k]
            out[i] = [(j, -s) for s, j in scored]
    return {i: found for i, found in out.items() if found}


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    centers = rng.standard_normal((6, 8))
    rows = [(i, (centers[i % 6] + 0.05 * rng.standard_normal(8)).tolist()) for i in range(600)]
    rows += [(1000 + i, [1.0] * 8) for i in range(200)]  # ties
    rows += [(5000, None), (5050, [float("nan")] * 8), (5100, [None] * 8), (5101, [])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for search in (
        topk.Search(least_pivots=8, block_rows=50),
        topk.Search(least_pivots=4, block_rows=30, chunk_rows=3, fan_in=4),
    ):
        assert answers(frame, search) == best(rows, 5)
    assert topk.top_k(frame.limit(0)).collect() == []
    assert topk.top_k(frame.where("vec_id = 0")).collect() == []


def answers(frame, search=topk.Search()):
    found = {}
    for r in sorted(topk.top_k(frame, search).collect()):
        assert r["rank"] == len(found.setdefault(r["query_id"], [])) + 1
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    return found


VECTORS = "vec_id bigint, embedding array<double>"


def test_a_task_gets_a_bounded_group(spark, monkeypatch):
    """A third of all vectors are equal, and all queries reach all blocks."""
    rows = [(i, [1.0, 2.0] if i % 3 == 0 else [float(i % 7), 1.0]) for i in range(900)]
    search = topk.Search(least_pivots=2, block_rows=100, chunk_rows=4, query_every=10)
    plain, seen = topk._solve, spark.sparkContext.accumulator(0)

    def measured(queries, data, k):
        if len(queries) > 4 or len(data) > 200:
            seen.add(1)
        return plain(queries, data, k)

    monkeypatch.setattr(topk, "_solve", measured)
    frame = spark.createDataFrame(rows, VECTORS)
    assert len(answers(frame, search)) == 90
    assert seen.value == 0


def test_large_components_are_exact(spark):
    """Beyond what doubles hold exactly, and beyond 64 bits, whose ends the scores then take."""
    rows = [(50, [1e9, -3.0]), (1, [1e3, 7.0]), (2, [1e3, 7.5]), (3, [-1e3, 0.0]), (4, [1.0, 1.0])]
    assert answers(spark.createDataFrame(rows, VECTORS)) == best(rows, 5)
    huge = [(50, [1e12, 1.0]), (1, [1e12, 0.0]), (2, [-1e12, 0.0]), (3, [2e12, 0.0]), (100, [0.0, 1.0])]
    found = answers(spark.createDataFrame(huge, VECTORS))
    assert found[50] == [(1, 2**63 - 1), (3, 2**63 - 1), (100, 65536), (2, -(2**63))]
    assert found[100] == [(50, 65536), (1, 0), (2, 0), (3, 0)]
    wild = [*huge, (5, [1e305, 1.0]), (6, [1.7e308, 0.0])]
    assert [i for i, _ in answers(spark.createDataFrame(wild, VECTORS))[50]] == [1, 3, 5, 100, 2]


def test_repeated_ids_and_short_vectors_have_one_place(spark):
    rows = [(50, [1.0, 1.0]), (1, [3.0, 0.0]), (1, [2.0, 9.0]), (1, [2.0, 9.0]), (2, [4.0]), (100, [0.0, 5.0]), (100, [1.0, 0.0])]
    found = answers(spark.createDataFrame(rows, VECTORS))
    assert found[50] == [(1, 11 * 65536), (100, 5 * 65536), (2, 4 * 65536)]
    assert found[100] == [(1, 45 * 65536), (50, 5 * 65536), (2, 0)]


def test_bounds_leave_out_far_cells():
    keep = topk._not_ruled_out(np.array([[10.0, 0.0, 9.0]]), np.array([[1.0, 1.0, 1.0]]), np.array([9, 9, 9]), 3)
    assert keep.tolist() == [[True, False, True]]
