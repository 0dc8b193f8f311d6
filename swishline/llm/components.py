"""Connected components by hooking to the smallest label and jumping over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swishline.sources.scratch import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and its ``label``, the smallest node that ``edges`` (a, b) reach from it.

    Nodes without an edge have no row; repeated edges and loops change nothing. Each
    round writes one row per node, and labels spread along paths that double in length.
    Minima are taken before the shuffle, so a node with many edges is no hot group.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = written(both.unionAll(both.select("other", "node")).distinct(), "edges")
    labels = both.groupBy("node").agg(F.least("node", F.min("other")).alias("label"))
    labels = written(labels, "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other")
        rows = labels.selectExpr("node", "label", "label AS old").unionByName(
            near.selectExpr("node", "label", "cast(null AS bigint) AS old")
        )
        low = rows.groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old"))
        low = written(low, "labels")
        over = low.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = low.join(over, "label").select(
            "node", F.col("further").alias("label"), (F.col("further") != F.col("old")).alias("new")
        )
        step = written(step, "labels")
        labels = step.select("node", "label")
        if not step.where("new").limit(1).count():
            return labels
