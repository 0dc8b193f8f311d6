"""Documents whose sets of word n-grams are similar: a prefix-filtered set join.

Every n-gram has a place in one order over all n-grams: rare ones first, by a sketch of
their counts over all documents, equal counts by hash. Two sets of Jaccard similarity t
or more share an n-gram in their prefixes of n - ceil(t n) + 1 in this order, whatever
the sketch has got wrong: it only decides how few candidates there are. Candidates pass
a length filter, a positional filter and a filter by counts in parts of the hash space
(as suffix filters divide what follows the prefix), and are verified once, on the sets
of their whole texts.

Rows with equal sets are one class from the start. Candidates are then made in two
steps, so that a group of near copies does not become all of its pairs. First each
prefix n-gram pairs its documents with one of them, the one in which it comes earliest.
Then the n-grams whose documents are still in several components pair those documents
across components. A pair within a component adds no component; every other pair with a
common prefix n-gram is looked at, so the components are exact.

All links, which ``similar`` counts, lie within components. There a component's classes
are dealt into blocks of bounded size by hash, blocks that share a prefix n-gram are
compared as wholes, and every link between two sets is counted: a group of near copies
costs its pairs here, but as products of small matrices instead of rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swishline.llm.components import components
from swishline.llm.tables import give_back, lookup_side, per_slice, slices, text_parts
from swishline.llm.words import _PLACES, Words, mixed, of_documents
from swishline.sources.scratch import written


@dataclass(frozen=True)
class Similarity:
    """``width``: words in an n-gram. ``percent``: Jaccard similarity that links, in percent.
    ``sketch_bits``: 2 to this power are the counters of the n-gram sketch."""

    width: int = 5
    percent: int = 80
    sketch_bits: int = 20

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - (self.percent * n + 99) // 100 + 1

    def overlap(self, a: Column, b: Column) -> Column:
        """Common n-grams that sets of sizes a and b need."""
        p = self.percent
        return F.floor((p * (a + b) + (100 + p - 1)) / F.lit(100 + p))

    def lengths_fit(self, a: Column, b: Column) -> Column:
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)


PARTS = 64
BLOCK_GRAMS = 1 << 15  # n-grams in the sets of a block, on average
BUNDLE_DOCS = 500  # of components of one block, which are compared in one call
HOT_DOCS = 2000  # of an n-gram; more are paired in parts
COLUMNS = 1 << 13  # n-grams in a matrix: a block of short sets has thousands of rows
SET_BYTES = 1 << 20  # of text whose sets are made at once: they take many times its size


def sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted set of n-grams of each text, one after the other, and n + 1 offsets.

    A text with fewer than ``width`` words has its whole sequence as its one n-gram;
    without words, and for null, the set is empty.
    """
    data, ends = text_parts(column)
    words = Words(data, ends, fold=True)
    numbers, first = words.windows(width)
    doc = words.doc[first]
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        alone = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = words.counts[short] > k
            alone[has] += words.hashes[words.ends[short[has]] + k] * _PLACES[k]
        alone = mixed(alone + words.counts[short].astype(np.uint64), 100)
        numbers, doc = np.concatenate([numbers, alone]), np.concatenate([doc, short])
    order = np.lexsort((numbers, doc))
    numbers, doc = numbers[order], doc[order]
    new = np.ones(len(numbers), bool)
    new[1:] = (numbers[1:] != numbers[:-1]) | (doc[1:] != doc[:-1])
    numbers, doc = numbers[new], doc[new]
    return numbers, np.searchsorted(doc, np.arange(len(ends)))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(ends) - 1, np.uint64)
    filled = ends[:-1] < ends[1:]
    if filled.any():
        out[filled] = np.add.reduceat(values, ends[:-1][filled])
    return out


def _slots(numbers: np.ndarray, bits: int) -> np.ndarray:
    return (numbers >> np.uint64(64 - bits)).astype(np.int64)


def _signatures(docs: DataFrame, s: Similarity) -> DataFrame:
    """A row per document: size and two sums over its set; a row per task: its sketch."""
    names = ["doc_id", "n", "hi", "lo", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << s.sketch_bits, np.uint32)
        for part in slices(batches, "text", SET_BYTES):
            numbers, ends = sets(part["text"], s.width)
            sketch += np.bincount(_slots(numbers, s.sketch_bits), minlength=len(sketch)).astype(
                np.uint32
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    pa.array(np.diff(ends)),
                    pa.array(_sums(mixed(numbers, 1), ends).view(np.int64)),
                    pa.array(_sums(mixed(numbers, 2), ends).view(np.int64)),
                    pa.nulls(part.num_rows, pa.binary()),
                ],
                names,
            )
        none = pa.nulls(1, pa.int64())
        packed = pa.array([zlib.compress(sketch.tobytes(), 1)], pa.binary())
        yield pa.RecordBatch.from_arrays([none, none, none, none, packed], names)

    schema = "doc_id bigint, n bigint, hi bigint, lo bigint, sketch binary"
    return written(docs.mapInArrow(run, schema), "signatures")


def _sketch(rows: DataFrame, tasks: int = 32) -> np.ndarray:
    """The sum of all sketches: summed in ``tasks`` tasks, then here; its size is fixed."""

    def unpacked(raw: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(raw), np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch["sketch"]:
                part = unpacked(raw.as_py())
                total = part.copy() if total is None else total + part
        if total is not None:
            packed = pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())
            yield pa.RecordBatch.from_arrays([packed], ["sketch"])

    parts = rows.where("sketch IS NOT NULL").select("sketch").repartition(tasks)
    found = [unpacked(r[0]) for r in parts.mapInArrow(run, "sketch binary").collect()]
    return np.sum(found, axis=0, dtype=np.uint32) if found else np.zeros(0, np.uint32)


def _prefixes(docs: DataFrame, sketch: np.ndarray, s: Similarity) -> DataFrame:
    """By document: the size of its set, the prefix in order, and its counts by part."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        numbers, ends = sets(part["text"], s.width)
        sizes = np.diff(ends)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        numbers = numbers[np.lexsort((numbers, shared.value[_slots(numbers, s.sketch_bits)], doc))]
        place = np.arange(len(numbers)) - np.repeat(ends[:-1], sizes)
        kept = np.where(sizes > 0, s.prefix(sizes), 0)
        chosen = numbers[place < np.repeat(kept, sizes)].view(np.int64)
        parts = np.bincount(
            doc * PARTS + (mixed(numbers, 3) % np.uint64(PARTS)).astype(np.int64),
            minlength=len(sizes) * PARTS,
        ).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                part["doc_id"],
                pa.array(sizes.astype(np.int32)),
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)),
                    pa.array(chosen),
                ),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * PARTS), pa.array(parts)
                ),
            ],
            ["doc_id", "n", "grams", "parts"],
        )

    schema = "doc_id bigint, n int, grams array<bigint>, parts array<int>"
    return written(docs.mapInArrow(per_slice(step, "text", SET_BYTES), schema), "prefixes")


def _met(shared: DataFrame) -> DataFrame:
    """With ``met``: how many n-grams of this table a document has before this one."""
    own = Window.partitionBy("doc_id").orderBy("pos")
    return shared.withColumn("met", F.row_number().over(own) - 1)


def _may_reach(s: Similarity) -> Column:
    """Length and positional filter for one common n-gram of x and y.

    An n-gram that both have before it is in both prefixes, so it is shared: of those
    before it, ``met`` counts only the shared ones.
    """
    x, y = F.col("x.n"), F.col("y.n")
    before = F.least("x.met", "y.met")
    after = F.least(x - F.col("x.pos"), y - F.col("y.pos"))
    return s.lengths_fit(x, y) & (before + after >= s.overlap(x, y))


def _pairs(joined: DataFrame) -> DataFrame:
    """One row per pair a < b: common prefix n-grams, and the last one's place in each."""
    in_order = F.col("x.doc_id") < F.col("y.doc_id")
    first, second = (F.struct(*(f"{t}.{c}" for c in ("doc_id", "n", "pos"))) for t in "xy")
    both = joined.select(
        F.when(in_order, first).otherwise(second).alias("a"),
        F.when(in_order, second).otherwise(first).alias("b"),
    )
    keys = F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b")
    return both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("common"),
        F.max("a.pos").alias("a_pos"),
        F.max("b.pos").alias("b_pos"),
        F.max("a.n").alias("a_n"),
        F.max("b.n").alias("b_n"),
    )


def _parts_fit(pairs: DataFrame, prefixes: DataFrame, s: Similarity) -> DataFrame:
    """Pairs whose counts by part of the hash space allow the overlap that they need."""
    parts = prefixes.select("doc_id", "parts").dropDuplicates(["doc_id"])
    smaller = F.zip_with("a_parts", "b_parts", lambda x, y: F.least(x, y))
    least = F.aggregate(smaller, F.lit(0), lambda total, x: total + x)
    return (
        pairs.join(parts.select(F.col("doc_id").alias("a"), F.col("parts").alias("a_parts")), "a")
        .join(parts.select(F.col("doc_id").alias("b"), F.col("parts").alias("b_parts")), "b")
        .where(least >= s.overlap(F.col("a_n"), F.col("b_n")))
        .select("a", "b")
    )


def _verified(pairs: DataFrame, docs: DataFrame, s: Similarity) -> DataFrame:
    """The pairs with ``linked``: whether the sets of the whole texts are similar enough."""
    needed = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct()
    needed = lookup_side(written(needed, "needed"))
    texts = docs.join(needed, "doc_id", "left_semi")
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        left, left_ends = sets(part["a_text"], s.width)
        right, right_ends = sets(part["b_text"], s.width)
        n, m = np.diff(left_ends), np.diff(right_ends)
        row = np.concatenate([np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)])
        keys = of_documents(np.concatenate([left, right]), row)
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        common = np.bincount(row[order[1:][same]], minlength=len(n))
        linked = 100 * common >= s.percent * (n + m - common)
        return pa.RecordBatch.from_arrays(
            [part["a"], part["b"], pa.array(linked & (n > 0))], ["a", "b", "linked"]
        )

    rows = pairs.join(b, "b").join(a, "a").select("a", "b", "a_text", "b_text")
    schema = "a bigint, b bigint, linked boolean"
    return written(rows.mapInArrow(per_slice(step, "a_text", SET_BYTES), schema), "verified")


def classes(docs: DataFrame, s: Similarity) -> tuple[DataFrame, DataFrame]:
    """Every row's doc_id, set size and class (its smallest doc_id); and the task sketches."""
    signatures = _signatures(docs, s)
    rows = signatures.where("sketch IS NULL").drop("sketch")
    same = ["n", "hi", "lo"]
    found = rows.where("n > 0").groupBy(*same).agg(F.min("doc_id").alias("class_id"))
    found = lookup_side(written(found, "classes"))
    member = rows.where("n > 0").join(found, same).select("doc_id", "n", "class_id")
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("class_id"))
    return written(member.unionAll(alone), "members"), signatures


def _indexed(
    docs: DataFrame, members: DataFrame, signatures: DataFrame, s: Similarity
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One document per class, the prefixes, and the prefix n-grams that several share."""
    copies = members.where("doc_id <> class_id").select("doc_id").distinct()
    kept = docs.where("doc_id IS NOT NULL").join(
        lookup_side(written(copies, "copies")), "doc_id", "left_anti"
    )
    prefixes = _prefixes(kept, _sketch(signatures), s)
    index = prefixes.select(F.posexplode("grams").alias("pos", "gram"), "doc_id", "n")
    counts = index.groupBy("gram").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1")
    shared = written(_met(index.join(counts.select("gram"), "gram")), "shared")
    return kept, prefixes, shared


def _across(labelled: DataFrame, prefixes: DataFrame, s: Similarity) -> DataFrame:
    """Candidate pairs of different labels. All n-grams that such a pair has in common in
    its prefixes have to be in ``labelled``: the positional filter counts them.

    The documents of an n-gram that very many share are dealt into parts of about HOT_DOCS,
    and each part meets all documents of the n-gram in a task of its own.
    """
    hot = labelled.groupBy("gram").agg(F.count(F.lit(1)).alias("docs"))
    hot = hot.where(F.col("docs") > HOT_DOCS)
    hot = hot.select("gram", F.ceil(F.col("docs") / HOT_DOCS).cast("int").alias("cuts"))
    cut = labelled.join(lookup_side(written(hot, "hot")), "gram", "left")
    cut = cut.withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    every = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    own = F.pmod(F.xxhash64("doc_id"), F.col("cuts")).cast("int")
    x, y = cut.withColumn("part", every).alias("x"), cut.withColumn("part", own).alias("y")
    joined = x.join(
        y,
        (F.col("x.gram") == F.col("y.gram"))
        & (F.col("x.part") == F.col("y.part"))
        & (F.col("x.label") < F.col("y.label"))
        & _may_reach(s),
    )
    after = F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos")) - 1
    pairs = _pairs(joined).where(F.col("common") + after >= s.overlap(F.col("a_n"), F.col("b_n")))
    return _parts_fit(pairs, prefixes, s)


def similar_pairs(docs: DataFrame, s: Similarity = Similarity()) -> DataFrame:
    """Every link between classes: a < b, the smallest doc_ids of two different sets.

    With the membership of ``near_duplicates`` (class_id) these are all similar pairs of
    documents. A group of near copies has as many links as pairs here; for components
    alone, ``near_duplicates`` does not need them all.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    kept, prefixes, shared = _indexed(docs, *classes(docs, s), s)
    pairs = _across(shared.withColumn("label", F.col("doc_id")), prefixes, s)
    return _verified(written(pairs, "pairs"), kept, s).where("linked").select("a", "b")


def links(kept: DataFrame, prefixes: DataFrame, shared: DataFrame, s: Similarity) -> DataFrame:
    """Verified links (a, b) between classes, enough to connect all that any link connects."""
    first = F.min(F.struct("pos", F.xxhash64("doc_id"), "doc_id", "n", "met")).alias("first")
    centers = shared.groupBy("gram").agg(first).select("gram", "first.*")
    x, y = shared.alias("x"), centers.alias("y")
    near = x.join(y, F.col("x.gram") == F.col("y.gram")).where(
        (F.col("x.doc_id") != F.col("y.doc_id")) & _may_reach(s)
    )
    tried = written(_parts_fit(_pairs(near), prefixes, s), "tried")
    found = _verified(tried, kept, s)

    labels = components(found.where("linked"))
    placed = shared.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    placed = written(placed.withColumn("label", F.coalesce("label", "doc_id")), "placed")
    several = placed.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_ = placed.join(several.where("low <> high").select("gram"), "gram")
    open_ = written(_met(open_.drop("met")), "open")
    rest = _across(open_, prefixes, s).join(tried, ["a", "b"], "left_anti")
    more = _verified(written(rest, "rest"), kept, s)
    return found.unionAll(more).where("linked").select("a", "b")


def _common(sides: list[np.ndarray], numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many n-grams the sets of the first side's rows have in common with the second's."""
    rows = np.concatenate(sides)
    sizes = np.diff(ends)[rows]
    starts = np.repeat(ends[:-1][rows] - np.cumsum(sizes) + sizes, sizes)
    row = np.repeat(np.arange(len(rows)), sizes)
    _, gram, often = np.unique(
        numbers[np.arange(len(row)) + starts], return_inverse=True, return_counts=True
    )
    several = often[gram] > 1
    row, gram = row[several], gram[several]
    order = np.argsort(gram, kind="stable")
    row, gram = row[order], gram[order]
    _, gram = np.unique(gram, return_inverse=True)
    first = len(sides[0])
    out = np.zeros((first, len(sides[1])), np.float64)
    for low in range(0, int(gram[-1]) + 1 if len(gram) else 0, COLUMNS):
        part = slice(*np.searchsorted(gram, [low, low + COLUMNS]))
        has = np.zeros((len(rows), int(gram[part.stop - 1]) - low + 1), np.float32)
        has[row[part], gram[part] - low] = 1
        out += has[:first] @ has[first:].T
    return out


def _counted(part: pa.Table, s: Similarity) -> pa.Table:
    """The links of the rows' classes: within one block, or between blocks 0 and 1 of ``side``."""
    numbers, ends = sets(part["text"], s.width)
    n = np.diff(ends)
    ids, size = part["doc_id"].to_numpy(), part["size"].to_numpy().astype(np.float64)
    label, side = part["label"].to_numpy(), part["side"].to_numpy()
    found, counts = [], []
    order = np.argsort(label, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
        between = bool(side[rows].any())
        left, right = (rows[side[rows] == k] for k in (0, 1)) if between else (rows, rows)
        common = _common([left, right], numbers, ends)
        linked = 100 * common >= s.percent * (n[left][:, None] + n[right] - common)
        linked &= (common > 0) & (ids[left][:, None] != ids[right])
        # versions of a document are one: it is linked if one of them is
        (a, a_first, a_id), (b, b_first, b_id) = (
            np.unique(ids[x], return_index=True, return_inverse=True) for x in (left, right)
        )
        pairs = np.zeros((len(a), len(b)), bool)
        x, y = np.nonzero(linked)
        pairs[a_id[x], b_id[y]] = True
        found.append(a)
        counts.append(pairs @ size[right][b_first])
        if between:
            found.append(b)
            counts.append(pairs.T @ size[left][a_first])
    ids, totals = np.concatenate(found), np.concatenate(counts).astype(np.int64)
    return pa.table({"class_id": pa.array(ids), "others": pa.array(totals)})


def _link_counts(
    kept: DataFrame, members: DataFrame, labels: DataFrame, shared: DataFrame, s: Similarity
) -> DataFrame:
    """class_id and ``others``: the documents of other classes that are linked to it."""
    sizes = members.where("class_id IS NOT NULL").groupBy("class_id").agg(
        F.count_distinct("doc_id").alias("size"), F.max("n").alias("n")
    )
    placed = sizes.join(lookup_side(labels.withColumnRenamed("node", "class_id")), "class_id")
    placed = written(placed, "sized")
    per = placed.groupBy("label").agg(
        F.ceil(F.sum("n") / F.lit(BLOCK_GRAMS)).cast("int").alias("blocks")
    )
    placed = placed.join(lookup_side(written(per, "blocks")), "label").select(
        F.col("class_id").alias("doc_id"),
        "label",
        "size",
        "blocks",
        F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int").alias("block"),
    )
    placed = written(placed, "in_blocks")

    large = placed.where("blocks > 1").select("doc_id", "label", "block")
    held = shared.select("doc_id", "gram").join(lookup_side(large), "doc_id")
    held = written(held.select("label", "gram", "block").distinct(), "held")
    i, j = held.withColumnRenamed("block", "i"), held.withColumnRenamed("block", "j")
    meet = i.join(j, ["label", "gram"]).where("i <= j").select("label", "i", "j").distinct()
    meet = written(meet, "meet")
    left = meet.select("label", F.col("i").alias("block"), "i", "j", F.lit(0).alias("side"))
    right = meet.where("i < j").select("label", F.col("j").alias("block"), "i", "j", F.lit(1))
    bundles = -(-placed.where("blocks = 1").count() // BUNDLE_DOCS)
    alone = placed.where("blocks = 1").select(
        "doc_id",
        "label",
        "size",
        F.pmod(F.xxhash64("label"), F.lit(max(1, bundles))).alias("call"),
        F.lit(-1).alias("i"),
        F.lit(-1).alias("j"),
        F.lit(0).alias("side"),
    )
    dealt = placed.where("blocks > 1").join(left.unionAll(right), ["label", "block"]).select(
        "doc_id", "label", "size", F.col("label").alias("call"), "i", "j", "side"
    )
    calls = lookup_side(written(alone.unionAll(dealt), "calls"))

    def count(part: pa.Table) -> pa.Table:
        out = _counted(part, s)
        give_back()
        return out

    rows = kept.join(calls, "doc_id").groupBy("call", "i", "j")
    found = rows.applyInArrow(count, "class_id bigint, others bigint")
    return written(found.groupBy("class_id").agg(F.sum("others").alias("others")), "link_counts")


def _components_of(
    docs: DataFrame, s: Similarity
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Members, labels of the linked classes, a document per class, shared prefix n-grams."""
    members, signatures = classes(docs, s)
    kept, prefixes, shared = _indexed(docs, members, signatures, s)
    labels = written(components(links(kept, prefixes, shared, s)), "components")
    return members, labels, kept, shared


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(
        lookup_side(labels.select(F.col("node").alias("class_id"), "label")), "class_id", "left"
    ).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "class_id",
        F.coalesce("label", "class_id").alias("component_id"),
    )


def near_duplicates(docs: DataFrame, s: Similarity = Similarity()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_id, component_id.

    ``class_id``: the smallest doc_id with the same set. ``component_id``: the smallest
    doc_id that links reach. Null texts and texts without words have empty sets and are
    their own component. A null doc_id keeps its row with a null class and component
    unless its set equals that of a document with an id. Rows that repeat a doc_id are
    versions of one document. Other columns are left out.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    return _labelled(*_components_of(docs, s)[:2])


def similar(docs: DataFrame, s: Similarity = Similarity()) -> DataFrame:
    """The rows of ``near_duplicates`` with ``n_links``: how many other documents are similar.

    Every link counts, those between equal sets too. Rows without a doc_id are no one's
    links; empty sets have none. A document whose versions are in several classes counts
    once for each.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    members, labels, kept, shared = _components_of(docs, s)
    others = _link_counts(kept, members, labels, shared, s)
    sizes = members.where("n > 0 AND class_id IS NOT NULL").groupBy("class_id").agg(
        F.count_distinct("doc_id").alias("size")
    )
    linked = written(sizes.join(lookup_side(others), "class_id", "left"), "linked")
    same = F.col("size") - F.col("doc_id").isNotNull().cast("int")
    n_links = F.when(F.col("n_shingles") > 0, same + F.coalesce("others", F.lit(0)))
    return (
        _labelled(members, labels)
        .join(lookup_side(linked), "class_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            "class_id",
            F.coalesce(n_links, F.lit(0)).cast("bigint").alias("n_links"),
        )
    )


def representatives(docs: DataFrame, s: Similarity = Similarity()) -> DataFrame:
    """The rows of ``docs`` of which none with a smaller doc_id is in the same component.

    Rows without a doc_id stay. Of rows that repeat a kept doc_id, all stay.
    """
    found = near_duplicates(docs, s)
    dropped = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(lookup_side(written(dropped, "dropped")), "doc_id", "left_anti").select(
        *docs.columns
    )
