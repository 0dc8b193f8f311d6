"""Top-k rows and splits, each one pass and no global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swishline.functions.keys import SEED, key_hash, key_percent

SAMPLE_LIMIT = 1000
SAMPLE_RANGE = (100, 5000)
MAP_POINTS = 200
TABLE_ROWS = 20


def latest_n(telemetry: DataFrame, n: int = SAMPLE_LIMIT) -> DataFrame:
    """The newest ``n`` rows: each task keeps its own top n, one merges them."""
    low, high = SAMPLE_RANGE
    if not low <= n <= high:
        raise ValueError(f"n must be within {low}..{high}, not {n}")
    return telemetry.orderBy(F.col("created_at").desc(), F.col("shot_id").desc()).limit(n)


def sample_n(rows: DataFrame, n: int = MAP_POINTS, seed: int = SEED) -> DataFrame:
    """A uniform sample of ``n`` rows without replacement, the same on every run."""
    return rows.orderBy(key_hash(F.col("shot_id"), seed), F.col("shot_id")).limit(n)


def recent_shots(telemetry: DataFrame, n: int = TABLE_ROWS) -> DataFrame:
    """The newest shots under their display names."""
    newest = telemetry.orderBy(F.col("created_at").desc(), F.col("shot_id").desc()).limit(n)
    return newest.select(
        F.col("player_name").alias("Player"),
        F.col("shot_distance").alias("Distance (ft)"),
        F.round("expected_points", 3).alias("Expected Points"),
        F.col("shot_grade").alias("Grade"),
        F.col("created_at").alias("Time"),
    )


def train_test_split(rows: DataFrame, key: Column, test_percent: int = 20) -> DataFrame:
    """Add ``split``. Both labels are held out at the same expected rate, and a
    row keeps its side whatever the partitioning or the rows around it."""
    side = F.when(key_percent(key) < test_percent, "test").otherwise("train")
    return rows.withColumn("split", side)
