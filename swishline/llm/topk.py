"""Exact k highest inner products: a join of Voronoi cells with bounds from summaries.

A sample gives pivots, more for more data up to a bound; every vector, query or candidate,
goes to the cell of its nearest pivot. For a query cell with pivot p and radius R, and a
data cell with pivot o and radius r, every score lies within  p.o -/+ (|p| r + R |o| + R r).
The lower bounds of all data cells, with their row counts, give each query cell a score
that its k-th best cannot fall below; data cells whose upper bound is below it are left
out. The same is done again for each query, with its own vector for p and R = 0. Only
these summaries, a row per cell, are sent to all tasks.

Queries, the smaller side, travel to the cells that are left. A cell is cut into blocks, and
queries into chunks, of bounded size: a task solves one chunk against one block. The best of
all blocks are merged by query, in rounds of bounded groups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swishline.sources.scratch import written

FOUND = "query_id bigint, vec_id bigint, score bigint"
EXACT_DOUBLE, LARGEST = 2**53, 2**63 - 1


@dataclass(frozen=True)
class Search:
    """``pivots``: a cell for about ``block_rows`` vectors, between ``least_pivots`` and
    ``most_pivots``, from a sample by hash of about four times as many rows. A block has
    about ``block_rows`` vectors and a chunk at most ``chunk_rows`` queries; answers of
    about ``fan_in`` blocks are merged at once."""

    k: int = 5
    scale: int = 256
    query_every: int = 50
    least_pivots: int = 64
    most_pivots: int = 4096
    block_rows: int = 4096
    chunk_rows: int = 4096
    fan_in: int = 1024
    seed: int = 11


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and ``v``, the components as floor(scale * x), of rows that hold finite numbers only.

    Rows with a null id, a null or empty vector, or a component that is null, NaN or
    infinite, before or after scaling, take no part. An id that several rows have stands
    for the least of their vectors. Shorter vectors count as filled up with zeros.
    """
    x = F.transform(F.col("embedding").cast("array<double>"), lambda v: v * F.lit(float(scale)))
    infinite = F.lit(float("inf"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < infinite))
    kept = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite)
    # whole numbers beyond 64 bits, and as doubles
    whole = F.transform(x, lambda v: F.when(F.abs(v) < 2.0**52, F.floor(v).cast("double")).otherwise(v))
    kept = kept.select(F.col("vec_id").cast("bigint"), whole.alias("v"))
    kept = kept.groupBy("vec_id").agg(F.min("v").alias("v"))
    width = kept.agg(F.max(F.size("v"))).scalar()
    zeros = F.array_repeat(F.lit(0.0), width - F.size("v"))
    return kept.select("vec_id", F.concat("v", zeros).alias("v"))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64).reshape(-1, width)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact. One that 64 bits cannot hold counts as
    the largest or least number that they hold."""
    limit = float(np.abs(q).max()) * float(np.abs(x).max()) * x.shape[1]
    if limit < EXACT_DOUBLE:  # sums of such products are exact in doubles
        return (q @ x.T).astype(np.int64)
    if limit < 2.0**62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    a, b = (np.array([[int(v) for v in row] for row in m], object) for m in (q, x))
    return np.clip(a @ b.T, -LARGEST - 1, LARGEST).astype(np.int64)


def pivots_of(vectors: DataFrame, count: int, s: Search) -> np.ndarray:
    """Vectors far from each other, of a bounded sample by hash."""
    wanted = min(max(s.least_pivots, count // s.block_rows), s.most_pivots)
    rate = min(1.0, 4 * wanted / max(count, 1))
    draw = F.pmod(F.xxhash64("vec_id", F.lit(s.seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = vectors.where(draw <= rate).orderBy("vec_id").limit(16 * wanted).collect()
    if not rows:
        rows = vectors.limit(1).collect()
    if not rows:
        return np.zeros((0, 1))
    sample = np.array([r["v"] for r in rows], np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        chosen = [0]
        far = ((sample - sample[0]) ** 2).sum(axis=1)
        while len(chosen) < wanted and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def with_cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """With the nearest pivot's cell and the distance to it."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def near(parts):
        points = shared.value
        for rows in parts:
            x = _matrix(rows["v"], points.shape[1])
            with np.errstate(over="ignore", invalid="ignore"):
                square = (x**2).sum(axis=1)[:, None] - 2 * x @ points.T + (points**2).sum(axis=1)
                cell = np.nan_to_num(square, nan=np.inf).argmin(axis=1)
                far = np.sqrt(((x - points[cell]) ** 2).sum(axis=1))
            yield rows.assign(cell=cell.astype(np.int32), far=far)

    return vectors.mapInPandas(near, "vec_id bigint, v array<double>, cell int, far double")


def _summaries(cells: DataFrame) -> pd.DataFrame:
    """Rows and radius by cell: at most ``most_pivots`` rows, made before the shuffle."""
    found = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"))
    return found.orderBy("cell").toPandas()


def cells_needed(
    queries: pd.DataFrame, cells: pd.DataFrame, pivots: np.ndarray, k: int
) -> dict[int, np.ndarray]:
    """By query cell, the places in ``cells`` that the bounds do not rule out."""
    o, r, n = pivots[cells["cell"]], cells["radius"].to_numpy(), cells["n"].to_numpy()
    size = np.sqrt((o**2).sum(axis=1))
    p, big = pivots[queries["cell"]], queries["radius"].to_numpy()[:, None]
    slack = np.sqrt((p**2).sum(axis=1))[:, None] * r + big * size + big * r
    keep = _not_ruled_out(p @ o.T, slack, n, k)
    return {int(c): np.flatnonzero(own) for c, own in zip(queries["cell"], keep, strict=True)}


def _not_ruled_out(middle: np.ndarray, slack: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """By row: groups of ``n`` vectors, with scores middle -/+ slack, that may hold a best k."""
    slack = slack * (1 + 1e-9) + np.abs(middle) * 1e-9 + 1e-6
    with np.errstate(over="ignore", invalid="ignore"):
        low = np.nan_to_num(middle - slack, nan=-np.inf, neginf=-np.inf, posinf=np.inf)
        high = np.nan_to_num(middle + slack, nan=np.inf, neginf=-np.inf, posinf=np.inf)
    order = np.argsort(-low, axis=1)
    # one more row than k: a query's own row does not count
    enough = np.cumsum(n[order], axis=1) >= k + 1
    place = np.take_along_axis(order, enough.argmax(axis=1)[:, None], axis=1)
    least = np.where(enough.any(axis=1), np.take_along_axis(low, place, axis=1)[:, 0], -np.inf)
    return high >= least[:, None]


def _sent(queries: DataFrame, needed: dict, cells: pd.DataFrame, pivots: np.ndarray, k: int):
    """Every query, with its chunk, once for each cell that its own bounds do not rule out."""
    shared = queries.sparkSession.sparkContext.broadcast((needed, cells, pivots))

    def run(parts):
        by_cell, table, points = shared.value
        radius, count = table["radius"].to_numpy(), table["n"].to_numpy()
        number = table["cell"].to_numpy()
        for rows in parts:
            for cell, own in rows.groupby("cell"):
                some = by_cell[cell]
                q = np.stack(own["v"].to_numpy())
                with np.errstate(over="ignore", invalid="ignore"):
                    slack = np.sqrt((q**2).sum(axis=1))[:, None] * radius[some]
                    keep = _not_ruled_out(q @ points[number[some]].T, slack, count[some], k)
                query, found = np.nonzero(keep)
                yield pd.DataFrame(
                    {
                        "q_id": own["vec_id"].to_numpy()[query],
                        "q": own["v"].to_numpy()[query],
                        "chunk": own["chunk"].to_numpy()[query],
                        "cell": number[some][found],
                    }
                )

    return queries.mapInPandas(run, "q_id bigint, q array<double>, chunk bigint, cell int")


def _solve(queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best k of one data block for every query of a chunk."""
    ids = data["vec_id"].to_numpy()
    order = np.argsort(ids)
    ids, x = ids[order], np.stack(data["v"].to_numpy())[order]
    own = queries["q_id"].to_numpy()
    parts = []
    for low in range(0, len(queries), 1024):
        q, q_ids = np.stack(queries["q"].iloc[low : low + 1024].to_numpy()), own[low : low + 1024]
        found = scores(q, x)
        # k + 1: a query's own row may be among them; a stable sort keeps smaller ids first
        top = np.argsort(~found, axis=1, kind="stable")[:, : k + 1]
        best = pd.DataFrame(
            {
                "query_id": np.repeat(q_ids, top.shape[1]),
                "vec_id": ids[top].ravel(),
                "score": np.take_along_axis(found, top, axis=1).ravel(),
            }
        )
        parts.append(best[best["query_id"] != best["vec_id"]].groupby("query_id").head(k))
    return pd.concat(parts)


def top_k(vectors: DataFrame, s: Search = Search()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``s.k`` best candidates of every query.

    Queries are the rows whose id is divisible by ``s.query_every``; candidates are all
    rows but the query's own; equal scores go to the smaller id. Without candidates a
    query has no rows. ``usable`` says which rows take part. Other columns are left out.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, s.scale), "vectors")
    count = rows.count()
    pivots = pivots_of(rows, count, s)
    if not len(pivots):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    cells = written(with_cells(rows, pivots), "cells")
    summaries = _summaries(cells)
    # blocks of a cell: at most ``most_pivots`` rows
    cuts = spark.createDataFrame(
        [(int(c), max(1, -(-int(n) // s.block_rows))) for c, n in zip(summaries["cell"], summaries["n"], strict=True)],
        "cell int, cuts int",
    )
    cuts = F.broadcast(cuts)
    blocks = cells.join(cuts, "cell").select(
        "vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id"), "cuts").cast("int").alias("block")
    )
    # stored with numbers that follow each other within a task: a chunk has no more rows than said
    queries = cells.where(F.col("vec_id") % s.query_every == 0)
    queries = written(queries.withColumn("at", F.monotonically_increasing_id()), "queries")
    queries = queries.withColumn("chunk", F.expr(f"at DIV {s.chunk_rows}"))
    needed = cells_needed(_summaries(queries), summaries, pivots, s.k)
    sent = written(_sent(queries, needed, summaries, pivots, s.k), "sent")
    key = ["cell", "block", "chunk"]
    asked = sent.join(cuts, "cell").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    )
    pairs = written(asked.select(*key).distinct(), "pairs")
    data = blocks.join(pairs, ["cell", "block"])

    def solve(q: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if q.empty or own.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return _solve(q, own, s.k)

    answers = (
        asked.select("q_id", "q", *key)
        .groupBy(*key)
        .cogroup(data.select("vec_id", "v", *key).groupBy(*key))
        .applyInPandas(solve, FOUND)
    )
    blocks_in_all = int((-(-summaries["n"] // s.block_rows)).sum())
    return _merged(answers, blocks_in_all, s)


def _merged(answers: DataFrame, blocks: int, s: Search) -> DataFrame:
    """The best of all blocks, in rounds that merge about ``fan_in`` blocks' answers a group."""
    order = [F.col("score").desc(), "vec_id"]
    rank = F.row_number()
    while blocks > s.fan_in:
        blocks = -(-blocks // s.fan_in)
        answers = answers.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
        own = rank.over(Window.partitionBy("query_id", "part").orderBy(*order))
        answers = answers.withColumn("rank", own).where(F.col("rank") <= s.k).drop("rank", "part")
    own = rank.over(Window.partitionBy("query_id").orderBy(*order))
    best = answers.withColumn("rank", own).where(F.col("rank") <= s.k)
    return best.select("query_id", "rank", "vec_id", "score")
