"""Main text of pages by wrappers: union-free regular expressions inferred by host.

A page is a nested stream of tags and text. Streams of one host are aligned one after
the other: tags that match stay, a tag on one side only becomes optional, neighbours
that repeat become one repeated item or group, and text that differs becomes a slot.
The result, the host's wrapper, tells template text (the same on every page) from
slots, and where the slots with the page's own text are. Every page is then read along
its host's wrapper.

Wrappers merge like pages do, so tasks fold the pages that they read, and a host with
many pages is merged from one small wrapper per task.
"""

from __future__ import annotations

import json
import sys
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swishline.llm.html_tree import HEADINGS, Node, parse, plain
from swishline.llm.tables import lookup_side
from swishline.sources.scratch import written

HOSTS_AT_ONCE = 2_000
MERGED_AT_ONCE = 64
TEMPLATE_PAGES = 3  # text is the template's if so many pages at least have it,
TEMPLATE_PERCENT = 90  # and so many of the host's, and no page has another text there
MARKED_PAGES = 5  # within an item that is marked as main it takes this many pages
SLOT_PERCENT = 50  # and slots that hold so much of its text: else pages are just alike
LONGEST_GROUP = 3
BROADCAST_HOSTS = 10_000
# pages may be nested deeply, and functions over their trees call themselves; calls from
# Python to Python take no room on the machine's stack
DEEPEST_CALLS = 10_000_000

# A wrapper is a dict: l label, t tag, k items in it, n pages, s text characters of its own,
# f its text if all pages agree (None: a slot), c the texts that it has on every page (several,
# if it is repeated), o optional, r repeated, x skipped, h hinted to be no text of the page's
# own, m marked main.


def of_page(node: Node) -> dict:
    """The wrapper that fits one page."""
    own = [plain(p) for p in node.parts if isinstance(p, str)]
    text = " ".join(p for p in own if p)
    closed = node.skip or node.header
    kids = [] if closed else [of_page(p) for p in node.parts if isinstance(p, Node)]
    return {
        "l": node.label,
        "t": node.tag,
        "k": _folded(kids),
        "n": 1,
        "s": len(text),
        "f": text,
        "c": [text] if text else [],
        "o": False,
        "r": False,
        "x": node.skip or node.header,
        "h": node.hint,
        "m": node.main or node.tag in ("article", "main"),
    }


def _group(items: list[dict]) -> dict:
    label = "(" + " ".join(i["l"] for i in items) + ")"
    out = {"l": label, "t": "()", "k": items, "n": max(i["n"] for i in items), "s": 0}
    out |= {"f": "", "c": [], "o": False, "r": True, "m": False}
    return {**out, "x": all(i["x"] for i in items), "h": all(i["h"] for i in items)}


def _folded(items: list[dict]) -> list[dict]:
    """Neighbours that repeat, alone or in groups, as one repeated item."""
    for size in range(1, LONGEST_GROUP + 1):
        out: list[dict] = []
        i = 0
        while i < len(items):
            labels = [x["l"] for x in items[i : i + size]]
            runs = 1
            while [x["l"] for x in items[i + runs * size : i + (runs + 1) * size]] == labels:
                runs += 1
            if runs > 1 and len(labels) == size:
                first = items[i : i + size]
                for k in range(1, runs):
                    again = items[i + k * size : i + (k + 1) * size]
                    pairs = zip(first, again, strict=True)
                    first = [_merged(a, b, same_page=True) for a, b in pairs]
                if size == 1:
                    # an item that pages may lack has nothing on every page
                    texts = {t for x in items[i : i + runs] if not x["o"] for t in x["c"]}
                    out.append({**first[0], "r": True, "c": sorted(texts)})
                else:
                    out.append(_group(first))
                i += runs * size
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _as_groups(items: list[dict], other: list[dict]) -> list[dict]:
    """Runs of items that are one round of a group on the other side, as that group."""
    for group in (g for g in other if g["t"] == "()"):
        want = [k["l"] for k in group["k"]]
        i, out = 0, []
        while i < len(items):
            if [x["l"] for x in items[i : i + len(want)]] == want:
                out.append(_group(items[i : i + len(want)]))
                i += len(want)
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _merged(a: dict, b: dict, same_page: bool = False) -> dict:
    """The wrapper that fits what ``a`` and what ``b`` fit."""
    return {
        "l": a["l"],
        "t": a["t"],
        "k": _aligned(a["k"], b["k"], same_page),
        "n": max(a["n"], b["n"]) if same_page else a["n"] + b["n"],
        "s": a["s"] + b["s"],
        "f": a["f"] if a["f"] == b["f"] else None,
        "c": sorted(set(a["c"]) | set(b["c"]) if same_page else set(a["c"]) & set(b["c"])),
        "o": a["o"] or b["o"],
        "r": a["r"] or b["r"],
        "x": a["x"],
        "h": a["h"],
        "m": a["m"] or b["m"],
    }


def _aligned(a: list[dict], b: list[dict], same_page: bool) -> list[dict]:
    if [x["l"] for x in a] == [x["l"] for x in b]:
        return [_merged(x, y, same_page) for x, y in zip(a, b, strict=True)]
    a, b = _as_groups(a, b), _as_groups(b, a)
    out, i, j = [], 0, 0
    for m, n in [*common([x["l"] for x in a], [x["l"] for x in b]), (len(a), len(b))]:
        out += [{**x, "o": True} for x in (*a[i:m], *b[j:n])]
        if m < len(a):
            out.append(_merged(a[m], b[n], same_page))
        i, j = m + 1, n + 1
    return _folded(out)


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places in ``a`` and ``b`` of a longest common subsequence, in order.

    Exact for lists of any length: divide and conquer over ``a`` keeps memory in line with
    the lists, and a row of the table is one whole number with a bit per item of ``b``.
    """
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    found = [(k, k) for k in range(low)]
    found += [
        (low + m, low + n) for m, n in _common(a[low : len(a) - high], b[low : len(b) - high])
    ]
    return found + [(len(a) - high + k, len(b) - high + k) for k in range(high)]


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [(0, b.index(a[0]))] if a[0] in b else []
    half = len(a) // 2
    before = _lengths(a[:half], b)
    after = _lengths(a[half:][::-1], b[::-1])
    cut = max(range(len(b) + 1), key=lambda n: before[n] + after[len(b) - n])
    right = _common(a[half:], b[cut:])
    return _common(a[:half], b[:cut]) + [(half + m, cut + n) for m, n in right]


def _lengths(a: list[str], b: list[str]) -> list[int]:
    """Lengths of the longest common subsequences of ``a`` and the beginnings of ``b``."""
    places: dict[str, int] = {}
    for n, label in enumerate(b):
        places[label] = places.get(label, 0) | 1 << n
    whole = (1 << len(b)) - 1
    row = whole  # a bit is 0 where the length grows
    for label in a:
        same = row & places.get(label, 0)
        row = ((row + same) | (row - same)) & whole
    bits = bin(row | 1 << len(b))[:2:-1]
    return [0, *accumulate(bit == "0" for bit in bits)]


def merged(wrappers: list[dict]) -> dict:
    """Pairwise, so that each is aligned about as often as any other."""
    while len(wrappers) > 1:
        pairs = zip(wrappers[::2], wrappers[1::2], strict=False)
        rest = wrappers[-1:] if len(wrappers) % 2 else []
        wrappers = [_merged(a, b) for a, b in pairs] + rest
    return wrappers[0]


# --- where a wrapper has the page's own text -----------------------------------------


def _least(w: dict) -> int:
    """Of the pages that have item ``w``, how many have to have a text in it that is the template's."""
    return max(TEMPLATE_PAGES, -(-w["n"] * TEMPLATE_PERCENT // 100))


def _own_texts(w: dict, least: int, known: dict) -> int:
    """Characters in slots under ``w``; template text and skipped or hinted parts do not
    count. ``known`` remembers the items that have been counted."""
    key = id(w), least
    if key not in known:
        total = 0
        if not w["x"] and not w["h"]:
            fixed = sum(map(len, w["c"])) if w["n"] >= least else 0
            total = max(0, w["s"] - w["n"] * fixed)
            for k in w["k"]:
                total += _own_texts(k, least, known)
        known[key] = total
    return known[key]


def _marked(w: dict, least: int, known: dict) -> list[tuple[int, list, dict]]:
    """Characters, path (last label first) and item of the outermost items marked as main,
    inner ones before outer."""
    if w["x"] or w["h"]:
        return []
    found: list = []
    for k in w["k"]:
        found += _marked(k, least, known)
    own = w["t"] != "()"
    if w["m"] and not (
        w["t"] != "article" and any(path[0].split(".")[0] == "article" for _, path, _ in found)
    ):
        found = [(_own_texts(w, least, known), [], w)]
    if own:
        for _, path, _ in found:
            path.append(w["l"])
    return found


def rule(w: dict) -> dict:
    """``path``: labels from the page down to the item with the main text; ``template``:
    items in it whose text belongs to the template: path, text, place among the items of the
    same label beside it, from the front and from the end (None where pages may differ in
    how many come before or after), and whether it is one of a run that begins and ends
    there. ``hints``: whether hinted blocks are left out."""
    known: dict = {}
    marked = _marked(w, _least(w), known)
    best = min(marked, key=lambda m: (-m[0], m[1][::-1]), default=None)
    if best is not None and best[0] > 0:
        at, path = best[2], best[1][::-1]
        least = max(_least(at), MARKED_PAGES)
        slots = _own_texts(at, least, known)
        # pages of the host that say the same all over are copies, and no template
        whole = _own_texts(at, at["n"] + 1, known)
        template = _template(at, least) if 100 * slots >= SLOT_PERCENT * whole else []
        return {"path": path, "template": template, "hints": True}
    path, at = [], w
    hints = _own_texts(w, _least(w), known) > 0
    while True:
        least = _least(at)
        kids = [k for g in at["k"] for k in (g["k"] if g["t"] == "()" else [g])]
        sizes = [_own_texts(k, least, known) for k in kids]
        size = max(sizes, default=0)
        # go down while one child alone, which is not one of several, holds most of the text
        if not kids or size < 0.7 * max(_own_texts(at, least, known), 1):
            break
        best = kids[sizes.index(size)]
        if best["r"] or not best["k"] and best["t"] in ("p", *HEADINGS):
            break
        # nor past a heading of its own beside that child
        if any(k["t"] in HEADINGS and n for k, n in zip(kids, sizes, strict=True)):
            break
        path.append(best["l"])
        at = best
    return {"path": ["", *path], "template": _template(at, least), "hints": hints}


def _template(at: dict, least: int) -> list:
    """The items below ``at`` whose text so many pages agree on, as ``rule`` tells them."""
    template: list = []

    def collect(items: list[dict], own: list, single: bool) -> None:
        for i, item in enumerate(items):
            if item["t"] == "()":
                collect(item["k"], own, False)
                continue
            own.append(item["l"])
            front, end = (
                _place(side, item["l"]) if single else None for side in (items[:i], items[i + 1 :])
            )
            for text in item["c"] if item["n"] >= least else ():
                template.append([list(own), text, front, end, item["r"]])
            collect(item["k"], own, True)
            own.pop()

    collect(at["k"], [], True)
    return template


def _place(items: list[dict], label: str) -> int | None:
    """How many nodes of ``label`` a page has for ``items``, if all pages have as many."""
    groups = [k["l"] for g in items if g["t"] == "()" for k in g["k"]]
    same = [x for x in items if x["l"] == label]
    return None if label in groups or any(x["o"] or x["r"] for x in same) else len(same)


def _find(node: Node, path: list[str]) -> list[Node]:
    """The nodes at ``path``; all of them, if it repeats."""
    found = [node]
    for label in path[1:]:
        found = [p for n in found for p in n.parts if isinstance(p, Node) and p.label == label]
    return found


def _of_template(node: Node, front: int, end: int, places: list) -> bool:
    """Whether the node has the text of a template item, where that item is."""
    text = " ".join(x for x in (plain(p) for p in node.parts if isinstance(p, str)) if x)
    for fixed, at, back, run in places:
        if text != fixed:
            continue
        if run and front >= (at or 0) and end >= (back or 0):
            return True
        if not run and (front == at or end == back or at is None and back is None):
            return True
    return False


class _Reader:
    """Reads the runs of text under a node along a rule."""

    def __init__(self, how: dict):
        self._hints = how["hints"]
        # template items by the labels that lead to them
        self._template: dict = {}
        for path, *place in how["template"]:
            at = self._template
            for label in path:
                at = at.setdefault(label, {})
            at.setdefault(None, []).append(place)
        self.out: list[str] = []

    def read(self, node: Node, at: dict | None, drop: bool, only: bool) -> None:
        """``at``: the template below this node; ``drop``: without its own text; ``only``: of
        headings."""
        run = ""
        labels = Counter(p.label for p in node.parts if isinstance(p, Node)) if at else {}
        met: Counter = Counter()
        for part in node.parts:
            if isinstance(part, str):
                run += part
                continue
            front = met[part.label]
            met[part.label] += 1
            if part.skip or (part.hint and self._hints):
                continue
            self.out.append("" if only or drop else run)
            run = ""
            below = at.get(part.label) if at else None
            end = labels[part.label] - 1 - front if at else 0
            fixed = below is not None and _of_template(part, front, end, below.get(None, []))
            inner = only and part.tag not in HEADINGS
            self.read(part, below, fixed, inner or part.header)
        self.out.append("" if only or drop else run)


def extract(page: str | None, how: dict | None) -> str:
    """The main text of a page by its host's rule, or by its own wrapper if that finds none."""
    if not page:
        return ""
    _calls_may_be_deep()
    tree = parse(page)
    for attempt in (how, None):
        attempt = attempt or rule(of_page(tree))
        reader = _Reader(attempt)
        for node in _find(tree, attempt["path"]):
            reader.read(node, reader._template, False, False)
        blocks = [b for b in map(plain, reader.out) if b]
        if blocks:
            return "\n".join(blocks)
    return ""


def _calls_may_be_deep() -> None:
    if sys.getrecursionlimit() < DEEPEST_CALLS:
        sys.setrecursionlimit(DEEPEST_CALLS)


FIELDS = ["l", "t", "n", "s", "f", "c", "o", "r", "x", "h", "m"]


def encoded(w: dict) -> str:
    """A wrapper as JSON without nesting: every item before its own, with their number."""
    rows, left = [], [w]
    while left:
        item = left.pop()
        rows.append([*(item[f] for f in FIELDS), len(item["k"])])
        left += item["k"][::-1]
    return json.dumps(rows)


def decoded(text: str) -> dict:
    top: dict = {"k": []}
    open_ = [(top, 1)]
    for *values, count in json.loads(text):
        while not open_[-1][1]:
            open_.pop()
        parent, missing = open_[-1]
        open_[-1] = parent, missing - 1
        item = {**dict(zip(FIELDS, values, strict=True)), "k": []}
        parent["k"].append(item)
        open_.append((item, count))
    return top["k"][0]


# --- over all pages ------------------------------------------------------------------


_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))


def wrappers(pages: DataFrame) -> DataFrame:
    """host and its encoded wrapper, from all of its pages; a stored table."""

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, dict] = {}
        _calls_may_be_deep()

        def out() -> pd.DataFrame:
            rows = [(h, encoded(w)) for h, w in known.items()]
            known.clear()
            return pd.DataFrame(rows, columns=["host", "wrapper"])

        for rows in parts:
            for host, page in zip(rows["host"], rows["html"], strict=True):
                w = of_page(parse(page))
                known[host] = _merged(known[host], w) if host in known else w
                if len(known) >= HOSTS_AT_ONCE:
                    yield out()
        yield out()

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        _calls_may_be_deep()
        whole = merged([decoded(x) for x in sorted(rows["wrapper"])])
        return pd.DataFrame({"host": rows["host"].iloc[:1], "wrapper": [encoded(whole)]})

    schema = "host string, wrapper string"
    found = pages.where("html IS NOT NULL").select("host", "html").mapInPandas(fold, schema)
    # a host with many pages has a wrapper from each task: they merge in bounded groups
    while True:
        found = written(found.withColumn("at", F.monotonically_increasing_id()), "wrappers")
        most = found.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return found.drop("at")
        part = F.pmod("at", F.lit(-(-most // MERGED_AT_ONCE)))
        found = found.groupBy("host", part.alias("part")).applyInPandas(merge, schema)


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points), host.

    Null and empty pages have empty text; pages without a host in their URL are one
    host; repeated rows are read each time; of items marked as main that hold equally much
    the first by their labels counts; other columns are left out.
    """
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    found = wrappers(rows)

    def rules(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _calls_may_be_deep()
        for own in parts:
            how = [json.dumps(rule(decoded(x))) for x in own["wrapper"]]
            yield pd.DataFrame({"host": own["host"], "how": how})

    by_host = written(found.mapInPandas(rules, "host string, how string"), "rules")
    joined = rows.join(lookup_side(by_host, BROADCAST_HOSTS), "host", "left")

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in parts:
            how = {h: json.loads(h) for h in own["how"].dropna().unique()}
            texts = [extract(p, how.get(h)) for p, h in zip(own["html"], own["how"], strict=True)]
            sizes = [len(t) for t in texts]
            yield own[["page_id", "url", "host"]].assign(text=texts, n_chars=sizes)

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"page_id {kinds['page_id']}, url string, host string, text string, n_chars bigint"
    return joined.mapInPandas(read, schema).select("page_id", "url", "text", "n_chars", "host")
