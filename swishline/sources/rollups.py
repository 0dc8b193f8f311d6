"""Roll-ups of telemetry days that are over: what the dashboard sums over all time.

``<path>_rollup/created_date=<d>/version=<v>``: for each compacted folder of the table a
row per zone and grade and a row per player. They add up, so a report over years reads a
few rows per day, and the shots themselves only of days that are not rolled up whole.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swishline.operators import analytics as A
from swishline.sources import files

ROLLED = (
    "kind string, zone string, shot_grade string, player_name string, shots bigint, "
    "points double, scored bigint, nearest int, created_date date, version bigint"
)
ZONES, PLAYERS = "zones", "players"
FOLDER = ["created_date", "version"]


def _place(path: str) -> str:
    return f"{path.rstrip('/')}_rollup"


def store(rows: DataFrame, path: str) -> None:
    """Roll up rows of compacted folders, by their ``created_date`` and ``version``, all in
    one job and each into one file; a second call replaces the first."""
    zones = A.zone_sums(rows, FOLDER).withColumn("kind", F.lit(ZONES))
    players = A.player_sums(rows, FOLDER).withColumn("kind", F.lit(PLAYERS))
    both = zones.unionByName(players, allowMissingColumns=True).repartition(*FOLDER)
    writer = both.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*FOLDER).parquet(_place(path))


def stored(spark: SparkSession, path: str) -> set[tuple[date, int]]:
    """Days and versions that are rolled up, by the names of files alone. A roll-up is
    one file, so it is whole as soon as it is there."""
    base = _place(path)
    if not files.is_there(spark, base):
        return set()
    found = set()
    for file in spark.read.schema(ROLLED).parquet(base).inputFiles():
        day, version = (part.split("=", 1)[1] for part in file.split("/")[-3:-1])
        found.add((date.fromisoformat(day), int(version)))
    return found


def read(spark: SparkSession, path: str, kind: str, places: set[tuple[date, int]]) -> DataFrame:
    """The rolled-up rows of those days and versions."""
    base = _place(path)
    if not places:
        return spark.createDataFrame([], ROLLED).drop("kind")
    folders = [f"{base}/created_date={d}/version={v}" for d, v in sorted(places)]
    rows = spark.read.schema(ROLLED).option("basePath", base).parquet(*folders)
    return rows.where(F.col("kind") == kind).drop("kind")
