"""Shards of near equal bytes by a k-d tree over the metadata of documents.

Every document is a point: its size, its doc_id, and its source and language as places by
hash, so that equal values share a place. The cell of all documents is cut in two along
the dimension in which it is widest, relative to the width of the whole, at the
weighted median (or the share that an odd number of shards asks for) of the bytes; so are
the halves, until a cell is one shard. All cells of a level are cut together.

A weighted median is found without moving or sorting rows: the bytes of a cell are
summed in up to ``cells`` buckets along its dimension, before any shuffle, and the
bucket that holds the goal is cut into buckets again. Points on the same place go on by
the hash of their text, and copies of one text by the row. So a cut is exact, and only
sums of buckets, never rows, reach the driver.

Copies of a text take the least doc_id, source and language of their group for their
own, so they are one place in all dimensions and stay in one shard, unless a cut falls on
the group and keeping it whole would miss the goal by more than ``whole`` of a shard.

DataFrame functions only. The driver holds a row per shard and the sums of one level.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swishline.sources.scratch import written

LAW = "bytes"
OVERHEAD = 8  # bytes that a document takes beside its text
PLACES = 1 << 62  # places in a dimension lie from 0 to below this
HOT_SHARE = 1000  # a text with more than this part of all rows is looked up by broadcast


@dataclass(frozen=True)
class Tree:
    """``shards``: number of leaves; or ``target_bytes``: as many as that takes.
    ``numeric`` and ``nominal``: columns that are dimensions beside the size. ``near`` and
    ``whole``: parts of a shard by which a cut may miss its goal, between buckets, and to
    keep the copies of a text together. ``cells``: buckets of one level."""

    shards: int = 24
    target_bytes: int | None = None
    numeric: Sequence[str] = ("doc_id",)
    nominal: Sequence[str] = ("source", "lang")
    near: float = 1e-4
    whole: float = 1e-3
    cells: int = 1 << 14


@dataclass
class Cut:
    """Where a cell is cut: rows whose key is below ``edge`` go left. The key is the place in
    dimension ``dim``; with ``phase`` 1 the text's hash among rows at place ``at``; with
    ``phase`` 2 the row among those of the text ``text`` there. While it is searched for,
    [low, high] holds it in buckets of ``step``, and ``below`` is what lies left of them."""

    node: int
    dim: int
    goal: float
    low: int
    high: int
    step: int = 1
    phase: int = 0
    at: int | None = None
    text: int | None = None
    below: int = 0
    edge: int | None = None


CUT_SCHEMA = (
    "node bigint, dim int, low bigint, high bigint, step bigint, phase int, at bigint, "
    "text bigint, edge bigint"
)


def points(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """The stored points: doc_id, size, text_crc32, copies (hash of the text), row_id, places,
    and their cell: at first the one of all."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = [*tree.numeric, *tree.nominal]
    nominal = {c: _place(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit("")))) for c in tree.nominal}
    numeric = {c: _place(F.coalesce(F.col(c).cast("bigint"), F.lit(0))) for c in tree.numeric}
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _place(F.xxhash64(text)).alias("copies"),
        *[(numeric | nominal)[c].alias(f"own_{i}") for i, c in enumerate(names)],
    )
    rows = written(rows, "shard_rows")
    least = [F.min(f"own_{i}").alias(f"p{i + 1}") for i in range(len(names))]
    groups = written(
        rows.groupBy("copies").agg(F.count(F.lit(1)).alias("n"), *least), "shard_groups"
    )
    # the texts of very many rows are fewer than HOT_SHARE: their rows need not move
    many = groups.agg(F.sum("n") / HOT_SHARE).scalar()
    hot = F.broadcast(groups.where(F.col("n") > many).drop("n"))
    plain = groups.where(F.col("n") <= many).drop("n")
    found = rows.join(hot, "copies").unionByName(
        rows.join(hot.select("copies"), "copies", "left_anti").join(plain, "copies")
    )
    return written(
        found.select(
            "doc_id", "size", "text_crc32", "copies",
            F.array("size", *[f"p{i + 1}" for i in range(len(names))]).alias("place"),
            F.monotonically_increasing_id().alias("row_id"),
            F.lit(1).cast("bigint").alias("node"),
        ),
        "shard_points",
    )


def _place(value: Column) -> Column:
    """A 64-bit number as a place, in the same order but for its last two bits."""
    return F.shiftright(value, 2) + F.lit(PLACES // 2)


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A row per cell: fewer than twice the shards."""
    kind = f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>"
    return F.broadcast(spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind))))


def _place_in_dim() -> Column:
    return F.get("place", F.col("dim"))


def _key() -> Column:
    deep = F.when(F.col("phase") == 1, F.col("copies")).otherwise(F.col("row_id"))
    return F.when(F.col("phase") == 0, _place_in_dim()).otherwise(deep)


def _in_phase() -> Column:
    """Rows that the search of their cell has not yet put left or right."""
    here = (F.col("phase") == 0) | (_place_in_dim() == F.col("at"))
    return here & ((F.col("phase") < 2) | (F.col("copies") == F.col("text")))


def _goes_left() -> Column:
    before = _place_in_dim() < F.col("at")
    at = _place_in_dim() == F.col("at")
    first = F.col("copies") < F.col("text")
    own = F.col("copies") == F.col("text")
    below = _key() < F.col("edge")
    return (
        F.when(F.col("phase") == 0, below)
        .when(F.col("phase") == 1, before | (at & below))
        .otherwise(before | (at & (first | (own & below))))
    )


def _extents(at: DataFrame, dims: int) -> dict[int, dict]:
    """Bytes and the least and largest places of every cell."""
    places = [
        f(F.get("place", F.lit(i))).alias(f"{n}{i}")
        for i in range(dims) for n, f in (("low", F.min), ("high", F.max))
    ]
    rows = at.groupBy("node").agg(F.sum("size").alias("bytes"), *places).collect()
    return {r["node"]: r.asDict() for r in rows}


def _narrowed(cut: Cut, buckets: list, near: float, whole: float) -> None:
    """Fix the cut's edge, or go on in the bucket that holds the goal."""
    done = cut.below
    for b in buckets:
        after = done + b["bytes"]
        if after >= cut.goal or b is buckets[-1]:
            break
        done = after
    first, last = b["least"], b["most"]
    miss, edge = min((abs(cut.goal - done), first), (abs(after - cut.goal), last + 1))
    single = first == last
    if miss <= near or (single and cut.phase == 1 and miss <= whole) or (single and cut.phase == 2):
        cut.edge = edge
        return
    cut.below = done
    if single:
        cut.phase += 1
        if cut.phase == 1:
            cut.at = first
        else:
            cut.text = first
        first, last = 0, 2 * PLACES - 1
    cut.low, cut.high = first, last


def _cuts(at: DataFrame, cuts: list[Cut], near: float, whole: float, cells: int) -> list[Cut]:
    """All cuts of a level, each round with one pass that sums the open cells' buckets."""
    spark = at.sparkSession
    count = max(2, cells // len(cuts))
    while open_cuts := [c for c in cuts if c.edge is None]:
        for c in open_cuts:
            c.step = (c.high - c.low) // count + 1
        rows = [{k: v for k, v in asdict(c).items() if k not in ("goal", "below")} for c in open_cuts]
        key = _key()
        summed = (
            at.join(_table(spark, rows, CUT_SCHEMA), "node")
            .where(_in_phase())
            .select("node", "size", key.alias("key"), "low", "high", "step")
            .where(F.col("key").between(F.col("low"), F.col("high")))
            .groupBy("node", F.expr("(key - low) DIV step").alias("bucket"))
            .agg(F.sum("size").alias("bytes"), F.min("key").alias("least"), F.max("key").alias("most"))
            .collect()  # at most ``cells`` rows
        )
        found: dict[int, list] = {}
        for r in sorted(summed, key=lambda r: r["bucket"]):
            found.setdefault(r["node"], []).append(r)
        for c in open_cuts:
            _narrowed(c, found[c.node], near, whole)
    return cuts


def _widest(cell: dict, whole: dict, dims: int) -> int:
    """The dimension in which a cell is widest, relative to the whole; the first of equals."""

    def width(i: int) -> float:
        extent = whole[f"high{i}"] - whole[f"low{i}"]
        return (cell[f"high{i}"] - cell[f"low{i}"]) / extent if extent else 0.0

    return max(range(dims), key=lambda i: (width(i), -i))


def with_shards(at: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """``points`` with their ``shard``, from 0."""
    spark = at.sparkSession
    dims = 1 + len(tree.numeric) + len(tree.nominal)
    extents = _extents(at, dims)
    if not extents:
        return at.withColumn("shard", F.lit(0)).drop("node")
    whole = extents[1]
    shards = tree.shards
    if tree.target_bytes:
        shards = max(1, -(-whole["bytes"] // tree.target_bytes))
    target = whole["bytes"] / shards
    leaves: list[dict] = []
    open_cells = {1: (0, shards)}  # by cell: its first shard and how many
    while open_cells:
        for node, (first, count) in list(open_cells.items()):
            if count == 1 or node not in extents:  # a cell without rows needs no cut
                leaves.append({"node": node, "shard": first})
                del open_cells[node]
        if not open_cells:
            break
        cuts = []
        for node, (_, count) in open_cells.items():
            cell = extents[node]
            dim = _widest(cell, whole, dims)
            goal = cell["bytes"] * (count // 2) / count
            cuts.append(Cut(node, dim, goal, cell[f"low{dim}"], cell[f"high{dim}"]))
        cuts = _cuts(at, cuts, tree.near * target, tree.whole * target, tree.cells)
        rows = [{k: v for k, v in asdict(c).items() if k not in ("goal", "below")} for c in cuts]
        own = at.columns
        child = F.col("node") * 2 + F.when(_goes_left(), 0).otherwise(1)
        moved = F.when(F.col("dim").isNull(), F.col("node")).otherwise(child)
        at = at.join(_table(spark, rows, CUT_SCHEMA), "node", "left").select(
            *[c for c in own if c != "node"], moved.alias("node")
        )
        open_cells = {
            2 * node + side: (first + side * (count // 2), count - count // 2 if side else count // 2)
            for node, (first, count) in open_cells.items() for side in (0, 1)
        }
        extents = _extents(at, dims)
    return at.join(_table(spark, leaves, "node bigint, shard int"), "node").drop("node")


def kd_shards(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document.

    ``size``: UTF-8 bytes of the text (null: none) and OVERHEAD. ``slot``: the document's
    place in its shard, from 0 without gaps. Shards are numbered through the tree from left
    to right; those that fewer documents than shards leave empty have no rows. A repeated
    row is a document of its own. Null sources and languages are one place each, a null
    doc_id lies at 0. ``grown_shard`` is null: sizes, not keys, decide.
    """
    placed = written(with_shards(points(docs, tree), tree), "shard_placed")
    placed = placed.withColumn("part", F.shiftright("row_id", 33))
    # numbered within the parts that tasks wrote, so that no shard is one task's
    parts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        "shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    own = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row_id")) - 1
    numbered = placed.withColumn("own", own).join(before, ["shard", "part"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("own") + F.col("before")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
