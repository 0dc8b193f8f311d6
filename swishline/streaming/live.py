"""Reports kept up to date by a stream instead of recomputed per refresh."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from swishline.functions import shots as S
from swishline.operators.analytics import grade_distribution_of
from swishline.sources import files
from swishline.streaming.checkpoints import exists, stream_id
from swishline.streaming.enrich import Scorer

LATE_BY = "10 minutes"
REFRESH = {"processingTime": "10 seconds"}
PARTITIONS = "spark.sql.shuffle.partitions"
STATE_PARTITIONS = 8
# older states are removed: readers of one have two refreshes to finish
KEPT_STATES = 3
# as many batches as Spark remembers the progress of
KEPT_COUNTS = 100

EVENTS_READ = "events_read"
MINUTES_SCHEMA = "minute timestamp, shots bigint, day date"
TOTALS_SCHEMA = "zone string, shot_grade string, shots bigint, points double, nearest int"


def _start(
    result: DataFrame,
    mode: str,
    store: Callable[[DataFrame, int], None],
    path: str,
    checkpoint: str,
    trigger: dict | None,
    state_partitions: int,
) -> StreamingQuery:
    spark = result.sparkSession
    if stream_id(spark, checkpoint) is None and exists(spark, path):
        raise ValueError(f"{path} belongs to a stream with another checkpoint")
    writer = result.writeStream.outputMode(mode).foreachBatch(store)
    writer = writer.option("checkpointLocation", checkpoint)
    with _state_partitions(spark, state_partitions):
        return writer.trigger(**(trigger or REFRESH)).start()


@contextmanager
def _state_partitions(spark: SparkSession, most: int) -> Iterator[None]:
    """Few state partitions for a query started in this block.

    Tasks send one row per minute or zone, however much they read: the default
    number of partitions would only cost tasks, state files and result files.
    A query keeps the number it was first started with.
    """
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, min(int(before), most))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, before)


def stream_shots_per_minute(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    late_by: str = LATE_BY,
    state_partitions: int = STATE_PARTITIONS,
) -> StreamingQuery:
    """Shots per minute of event time, as a tumbling window.

    Update mode: each micro-batch merges the minutes it changed into the table of their
    days, one row per minute and a folder per day, and the watermark lets finished
    minutes leave the state. Events later than that are dropped, so state stays at
    minutes of lateness, not at history; ``late_rows`` counts them. A replay of history
    should be published in order of time (``publish_history``), or needs a ``late_by``
    that spans it. Events without a time are in no minute.

    The state is computed once per micro-batch: the changed minutes are stored first, and
    everything else reads that copy, so a lost task repeats no part of the state.
    """
    path = path.rstrip("/")
    # events with a time, counted as they are read: what of them is in no minute is late
    read = events.where("event_time IS NOT NULL").observe(
        EVENTS_READ, F.count(F.lit(1)).alias("events")
    )
    per_minute = (
        read.withWatermark("event_time", late_by)
        .groupBy(F.window("event_time", "1 minute").alias("w"))
        .agg(F.count(F.lit(1)).alias("shots"))
        .select(F.col("w.start").alias("minute"), "shots")
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        copy = f"{path}_changed"
        batch.withColumn("day", F.to_date("minute")).write.mode("overwrite").parquet(copy)
        changed = spark.read.schema(MINUTES_SCHEMA).parquet(copy)
        staged = f"{path}_staged"  # an overwritten day cannot be read by the same write
        merged, before = changed, spark.createDataFrame([], MINUTES_SCHEMA)
        if files.is_there(spark, path):
            stored = spark.read.schema(MINUTES_SCHEMA).parquet(path)
            own_days = stored.join(changed.select("day").distinct(), "day", "left_semi")
            kept = own_days.join(changed.select("minute"), "minute", "left_anti")
            merged = changed.unionByName(kept)
            before = stored.join(changed.select("minute", "day"), ["minute", "day"], "left_semi")
        _count_taken(path, batch_id, changed, before)
        merged.coalesce(1).write.mode("overwrite").parquet(staged)
        writer = spark.read.schema(MINUTES_SCHEMA).parquet(staged).write.partitionBy("day")
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)

    return _start(per_minute, "update", merge, path, checkpoint, trigger, state_partitions)


def _count_taken(path: str, batch_id: int, changed: DataFrame, before: DataFrame) -> None:
    """Store how many events a micro-batch has added to its minutes: their counts now,
    less those ``before``. A batch that runs again after it was merged keeps its number."""
    spark = changed.sparkSession
    own = f"{path}_taken/batch_id={batch_id}"
    if files.is_there(spark, f"{own}/_SUCCESS"):
        return
    counts = changed.select("shots").unionAll(before.select(-F.col("shots")))
    taken = counts.agg(F.coalesce(F.sum("shots"), F.lit(0)).alias("taken"))
    taken.write.mode("overwrite").parquet(own)
    for old in map(int, files.values(spark, f"{path}_taken", "batch_id")):
        if old <= batch_id - KEPT_COUNTS:
            files.remove(spark, f"{path}_taken/batch_id={old}")


def late_rows(query: StreamingQuery, path: str) -> int:
    """Events that came after their minute had left the state, in the batches that Spark
    still remembers of this run: those read, less those that the minutes below ``path`` took."""
    spark = SparkSession.active()
    read = {
        p["batchId"]: p["observedMetrics"][EVENTS_READ]["events"]
        for p in query.recentProgress
        if EVENTS_READ in p.get("observedMetrics", {})
    }
    folder = f"{path.rstrip('/')}_taken"
    if not read or not files.is_there(spark, folder):
        return 0
    counts = spark.read.schema("taken bigint, batch_id bigint").parquet(folder)
    taken = counts.where(F.col("batch_id").isin(list(read))).collect()
    return sum(read.values()) - sum(r["taken"] for r in taken)


def shots_per_minute_now(spark: SparkSession, path: str) -> DataFrame:
    """The stored count of each minute."""
    stored = spark.read.schema(MINUTES_SCHEMA).parquet(path.rstrip("/"))
    return stored.select("minute", "shots")


def stream_running_totals(
    telemetry: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    state_partitions: int = STATE_PARTITIONS,
) -> StreamingQuery:
    """One small state (zone x grade, at most 15 rows) behind all headline reports.

    Complete mode: each micro-batch stores the whole state as it stands, and removes
    all but the newest few before it.
    """
    path = path.rstrip("/")

    def store(batch: DataFrame, batch_id: int) -> None:
        _store_state(batch, path, batch_id)

    totals = _totals(telemetry)
    return _start(totals, "complete", store, path, checkpoint, trigger, state_partitions)


def stream_live_totals(
    events: DataFrame,
    scorer: Scorer,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The same totals over events that ``scorer`` scores as they come.

    Each micro-batch takes up newer artifacts first, so new models and ratings count from
    the next batch on without a restart; shots that have been counted keep their scores.
    A batch's totals are added to the state of the batch before it and stored as a state
    of its own: one that runs again starts from the same state and replaces its own.
    """
    path = path.rstrip("/")

    def add(batch: DataFrame, batch_id: int) -> None:
        scorer.refresh()
        before = running_totals_now(batch.sparkSession, path, before=batch_id)
        both = _totals(scorer.score(batch)).unionByName(before)
        summed = both.groupBy("zone", "shot_grade").agg(
            F.sum("shots").alias("shots"),
            F.sum("points").alias("points"),
            F.min("nearest").alias("nearest"),
        )
        _store_state(summed, path, batch_id)

    return _start(events, "append", add, path, checkpoint, trigger, STATE_PARTITIONS)


def _totals(telemetry: DataFrame) -> DataFrame:
    zone = S.zone(F.col("shot_distance")).alias("zone")
    return telemetry.groupBy(zone, "shot_grade").agg(
        F.count(F.lit(1)).alias("shots"),
        F.sum("expected_points").alias("points"),
        F.min("shot_distance").alias("nearest"),
    )


def _store_state(totals: DataFrame, path: str, batch_id: int) -> None:
    """Store a batch's state, and remove all but the newest few before it."""
    spark = totals.sparkSession
    totals.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    for old in map(int, files.values(spark, path, "batch_id")):
        if old <= batch_id - KEPT_STATES:
            files.remove(spark, f"{path}/batch_id={old}")


def running_totals_now(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The newest state that is stored whole, of all batches or those ``before`` one."""
    path = path.rstrip("/")
    states = sorted(map(int, files.values(spark, path, "batch_id")))
    whole = [
        n for n in states
        if (before is None or n < before) and files.is_there(spark, f"{path}/batch_id={n}/_SUCCESS")
    ]
    if not whole:
        return spark.createDataFrame([], TOTALS_SCHEMA)
    return spark.read.schema(TOTALS_SCHEMA).parquet(f"{path}/batch_id={whole[-1]}")


def headline(totals: DataFrame) -> DataFrame:
    """Total shots and mean expected points."""
    return totals.agg(
        F.coalesce(F.sum("shots"), F.lit(0)).alias("total_shots"),
        F.coalesce(F.try_divide(F.sum("points"), F.sum("shots")), F.lit(0.0)).alias("avg_xp"),
    )


def grades(totals: DataFrame) -> DataFrame:
    return grade_distribution_of(totals, F.col("shots"))


def zones(totals: DataFrame) -> DataFrame:
    per_zone = totals.groupBy("zone").agg(
        F.sum("shots").alias("shots"),
        (F.sum("points") / F.sum("shots")).alias("avg_xp"),
        F.min("nearest").alias("nearest"),
    )
    return per_zone.orderBy(F.col("nearest").asc_nulls_last()).select("zone", "shots", "avg_xp")
