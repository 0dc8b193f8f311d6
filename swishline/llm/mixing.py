"""Mixing sources to target weights: proportionate-fair scheduling of blocks.

A block is a run of documents of one source; one slot of the mix takes one block. Think of
the mix as a fluid first: all sources flow at once, in proportion to their weights, and
when one runs out the others flow on with its part. The time at which the fluid begins
block i of a source is the block's release, rounded down to a slot, and the time at which
it ends the block is its deadline, rounded up. Of the released blocks the one with the
earliest deadline goes first. The fluid meets all these windows, so whole blocks can too, and
earliest deadline first does: a source is never a whole block ahead of its share or
behind it, also where others have run out.

The fluid needs no walk: if V is what has flowed per unit of weight, then
T(V) = sum over sources of min(blocks, weight * V) slots have passed, a chain of straight
lines with one bend per source. Weights are exact whole numbers, never rounded. So windows
follow from one sorted list of sources, and the schedule from one pass over the blocks,
of which there is a bounded number: blocks grow with the documents.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swishline.llm.tables import lookup_side
from swishline.sources.scratch import written

BUCKET_ROWS = 4_000
KEYS = ["source_key", "bucket"]


@dataclass(frozen=True)
class Mix:
    """``weights``: target share by source, any scale; none: the square root of each source's
    blocks. Sources without a weight follow when all others have run out, in proportion to
    their documents. ``block``: documents in a block, or more, so that there are at most
    ``most_blocks`` and one per source."""

    weights: Mapping[str, float] | None = None
    block: int = 16
    most_blocks: int = 1 << 20


def exact(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in the very proportions of ``weights``."""
    parts = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*{x.denominator for x in parts.values()})
    whole = {s: x.numerator * (scale // x.denominator) for s, x in parts.items()}
    common = math.gcd(*whole.values())
    return {s: x // common for s, x in whole.items()}


class Fluid:
    """When the fluid is at a block of a source; sources by number, ``weights`` whole."""

    def __init__(self, blocks: list[int], weights: list[int]):
        self._weights = weights
        order = sorted(range(len(blocks)), key=lambda s: Fraction(blocks[s], weights[s]))
        # what has flowed per weight when each source runs out, and the lines between
        self._ends = [(blocks[s], weights[s]) for s in order]
        self._near = [blocks[s] / weights[s] for s in order]
        self._done = [0, *accumulate(blocks[s] for s in order)]
        total = sum(weights)
        self._open = [total, *(total - x for x in accumulate(weights[s] for s in order))]

    def time(self, source: int, block: int) -> tuple[int, int]:
        """The slots that have passed when ``source`` comes to ``block``: a fraction, as
        numerator and denominator."""
        weight = self._weights[source]
        line = bisect_right(self._near, block / weight)
        # doubles may be a line off where two bends lie close
        while line and self._ends[line - 1][0] * weight > block * self._ends[line - 1][1]:
            line -= 1
        while line < len(self._ends) and self._ends[line][0] * weight <= block * self._ends[line][1]:
            line += 1
        return self._done[line] * weight + self._open[line] * block, weight

    def release(self, source: int, block: int) -> int:
        over, under = self.time(source, block)
        return over // under

    def deadline(self, source: int, block: int) -> int:
        over, under = self.time(source, block + 1)
        return -(-over // under)


def turns(blocks: list[int], weights: list[int]) -> Iterator[tuple[int, int]]:
    """Source and block of every slot, earliest deadline first; equal deadlines by source."""
    fluid = Fluid(blocks, weights)
    later = [(0, s, 0) for s in range(len(blocks))]  # by release; a heap as it is
    waiting: list[tuple[int, int, int]] = []
    for slot in range(sum(blocks)):
        while later and later[0][0] <= slot:
            _, s, i = heapq.heappop(later)
            heapq.heappush(waiting, (fluid.deadline(s, i), s, i))
        _, s, i = heapq.heappop(waiting)
        yield s, i
        if i + 1 < blocks[s]:
            heapq.heappush(later, (fluid.release(s, i + 1), s, i + 1))


def schedule(blocks: Mapping[str, int], mix: Mix) -> Iterator[tuple[str, int]]:
    """Source and block of every slot of the whole mix."""
    own = {s: n for s, n in sorted(blocks.items()) if n}
    if mix.weights is None:
        rounds = [{s: n**0.5 for s, n in own.items()}]
    else:
        weighted = {s: mix.weights[s] for s in own if mix.weights.get(s, 0) > 0}
        rounds = [weighted, {s: float(own[s]) for s in own if s not in weighted}]
    for weights in filter(None, rounds):
        names, whole = list(weights), exact(weights)
        for s, i in turns([own[x] for x in names], [whole[x] for x in names]):
            yield names[s], i


def _slots_table(spark: SparkSession, blocks: dict[str, int], mix: Mix) -> DataFrame:
    """source_key, mix_block and mix_slot of every block."""
    rows = pd.DataFrame(schedule(blocks, mix), columns=["source_key", "mix_block"])
    rows["mix_slot"] = range(len(rows))
    schema = "source_key string, mix_block bigint, mix_slot bigint"
    empty = spark.createDataFrame([], schema)
    return written(spark.createDataFrame(rows, schema), "mix_slots") if len(rows) else empty


def mixed(docs: DataFrame, mix: Mix = Mix(), source: str = "source") -> DataFrame:
    """All rows of ``docs``, each as ``row``, with source_key, mix_block, mix_slot, mix_place.

    ``mix_slot`` is the block's place in the mix and ``mix_place`` the row's place in it.

    Within a source, documents are dealt in an order by hash of all columns, so that only
    rows that are equal in everything are interchangeable. Rows without a source are a
    source of their own, named ''. Repeated rows are documents like others. A source is
    numbered in buckets of bounded size, so a large one is not one task's. The driver holds
    a row per source and per block: ``mix`` bounds the blocks.
    """
    spark = docs.sparkSession
    order = F.xxhash64("doc_id", "text")
    rest = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in docs.columns])
    key = F.coalesce(F.col(source).cast("string"), F.lit(""))
    total = docs.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    block = max(mix.block, -(-total // mix.most_blocks))
    keyed = docs.select(
        F.struct(*docs.columns).alias("row"),
        key.alias("source_key"),
        F.pmod(order, F.lit(buckets)).cast("int").alias("bucket"),
        order.alias("mix_order"),
        rest.alias("mix_rest"),
    )
    counts = written(keyed.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")), "mix_counts")
    totals = {
        r["source_key"]: r["n"]
        for r in counts.groupBy("source_key").agg(F.sum("n").alias("n")).collect()
    }  # one row per source, which the weights list
    blocks = {s: -(-n // block) for s, n in totals.items()}

    earlier = Window.partitionBy("source_key").orderBy("bucket")
    so_far = F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select(*KEYS, F.coalesce(so_far, F.lit(0)).alias("before"))
    in_bucket = Window.partitionBy(*KEYS).orderBy("mix_order", "mix_rest")
    ranked = keyed.withColumn("mix_rank", F.row_number().over(in_bucket) - 1)
    ranked = ranked.join(lookup_side(written(before, "mix_before")), KEYS)
    rank = F.col("mix_rank") + F.col("before")
    ranked = ranked.withColumns(
        {
            "mix_block": F.floor(rank / F.lit(block)).cast("bigint"),
            "mix_place": (rank % block).cast("int"),
        }
    )
    slots = _slots_table(spark, blocks, mix)
    # one row per block: beyond the limit of a broadcast both sides shuffle by their blocks
    return ranked.join(lookup_side(slots), ["source_key", "mix_block"]).select(
        "row", "source_key", "mix_block", "mix_slot", "mix_place"
    )


def in_mix_order(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The rows and columns of ``docs``, in files that follow each other in the order of the mix."""
    ordered = mixed(docs, mix).repartitionByRange("mix_slot", "mix_place")
    return ordered.sortWithinPartitions("mix_slot", "mix_place").select("row.*")
