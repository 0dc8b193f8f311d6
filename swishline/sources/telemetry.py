"""The telemetry table: scored shots, appended batch by batch.

Files: ``<path>/created_date=<d>/stream_id=<s>/batch_id=<n>/*.parquet``. A batch that
runs again after a crash overwrites its own folders, so no row is stored twice; several
streams, or one begun anew, share a table without meeting; and time-bounded reads list
and open only the folders of their days.

A day that is over is compacted: its batches are written once more as large files below
``stream_id=compacted``, and a row per stream in ``<path>_compacted`` says up to which
batch. Readers take compacted files and the later batches; files that are not listed
yet, or no longer needed, are passed over, so nobody sees a day half done. The next
compaction removes what the one before it has replaced. What compaction has written is also
rolled up (``rollups``), for reports that sum over all time. JDBC: plain append; a batch
that is retried after a partial commit can repeat rows there.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swishline.operators import analytics as A
from swishline.schemas import TELEMETRY, TELEMETRY_COLUMNS
from swishline.sources import files, rollups

PLACE = ["created_date", "stream_id", "batch_id"]
STORED = T.StructType(
    [
        *TELEMETRY.fields,
        T.StructField("created_date", T.DateType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
COMPACTED = "compacted"
# up to which batch the streams of a day are in the compacted folder of that version
LISTED = "created_date date, stream_id string, upto bigint, version bigint"


def append_telemetry(
    scored: DataFrame, path: str, batch_id: int, stream_id: str = "direct"
) -> None:
    """Store one batch. Rows are gathered by day first, so that a wide batch does
    not leave a file per task and day; adaptive execution cuts a big day into
    several well-sized files, and no task gets the whole day. A batch that may run
    again needs the same created_at each time, as ``stream_enrich`` gives it."""
    rows = scored.select(*TELEMETRY.fieldNames()).withColumns(
        {
            "created_date": F.to_date("created_at"),
            "stream_id": F.lit(stream_id),
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
    )
    _write(rows, path)


def _write(rows: DataFrame, path: str) -> None:
    """Replace the folders of days, streams and batches that ``rows`` has."""
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        rows = rows.hint("rebalance", "created_date")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PLACE).parquet(path.rstrip("/"))


def batch_folder(path: str, stream_id: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/stream_id={stream_id}/batch_id={batch_id}"


def append_telemetry_jdbc(scored: DataFrame, url: str, table: str, **options: str) -> None:
    """Append to a database table that has the telemetry columns (no shot_id)."""
    rows = scored.select(*TELEMETRY_COLUMNS[1:])
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """Days of the table, oldest first, by the names of its folders."""
    return [date.fromisoformat(d) for d in files.values(spark, path, "created_date")]


def _stored(spark: SparkSession, path: str, days: Sequence[date] | None = None) -> DataFrame:
    """Rows with their place; only the folders of ``days`` are listed, if given."""
    path = path.rstrip("/")
    reader = spark.read.schema(STORED).option("basePath", path)
    if days is None:
        return reader.parquet(path)
    if not days:
        return spark.createDataFrame([], STORED)
    return reader.parquet(*[f"{path}/created_date={d}" for d in days])


def _listed(spark: SparkSession, path: str) -> DataFrame:
    listed = f"{path.rstrip('/')}_compacted"
    if not files.is_there(spark, listed):
        return spark.createDataFrame([], LISTED)
    return spark.read.schema(LISTED).parquet(listed)


def _current(spark: SparkSession, path: str, days: Sequence[date] | None = None) -> DataFrame:
    """Each stored row once: from a compacted folder, or from a later batch."""
    rows = _stored(spark, path, days)
    if not files.is_there(spark, f"{path.rstrip('/')}_compacted"):
        return rows.where(F.col("stream_id") != COMPACTED)
    listed = _listed(spark, path)
    # a row per day and stream: few, whatever the table holds
    upto = listed.groupBy("created_date", "stream_id").agg(F.max("upto").alias("upto"))
    versions = listed.select(
        "created_date", F.lit(COMPACTED).alias("stream_id"), F.col("version").alias("batch_id")
    ).distinct()
    batches = rows.where(F.col("stream_id") != COMPACTED).join(
        F.broadcast(upto), ["created_date", "stream_id"], "left"
    )
    later = batches.where(F.col("upto").isNull() | (F.col("batch_id") > F.col("upto")))
    compacted = rows.where(F.col("stream_id") == COMPACTED)
    compacted = compacted.join(F.broadcast(versions), PLACE, "left_semi")
    return later.select(*rows.columns).unionByName(compacted.select(*rows.columns))


def compact(spark: SparkSession, path: str, before: date) -> int:
    """Compact the days before ``before``; returns how many had anything new.

    Folders that an earlier call has replaced are removed first, so readers have from
    one call to the next to finish. Call it once a day, from one place.
    """
    path = path.rstrip("/")
    days = [d for d in stored_days(spark, path) if d < before]
    listed = _listed(spark, path)
    for row in listed.groupBy("created_date", "stream_id").agg(F.max("upto").alias("upto")).collect():
        folder = f"{path}/created_date={row['created_date']}/stream_id={row['stream_id']}"
        for batch in files.values(spark, folder, "batch_id"):
            if int(batch) <= row["upto"]:
                files.remove(spark, f"{folder}/batch_id={batch}")
    done = 0
    for day in days:
        folder = f"{path}/created_date={day}"
        known = {r["stream_id"]: r["upto"] for r in _upto(listed, day).collect()}
        streams = {}
        for stream in files.values(spark, folder, "stream_id"):
            batches = map(int, files.values(spark, f"{folder}/stream_id={stream}", "batch_id"))
            newest = max(batches, default=-1)
            if stream != COMPACTED and newest > known.get(stream, -1):
                streams[stream] = newest
        if not streams:
            continue
        version = time.time_ns() // 1000
        rows = _current(spark, path, [day]).where(F.col("stream_id") != COMPACTED)
        rows = rows.withColumns({"stream_id": F.lit(COMPACTED), "batch_id": F.lit(version)})
        _write(rows, path)
        entries = [(day, stream, upto, version) for stream, upto in streams.items()]
        listing = spark.createDataFrame(entries, LISTED).coalesce(1)
        listing.write.mode("append").parquet(f"{path}_compacted")
        done += 1
    roll_up(spark, path)
    return done


def roll_up(spark: SparkSession, path: str) -> int:
    """Roll up the compacted folders that have no roll-up yet; returns how many."""
    path = path.rstrip("/")
    missing = _compacted_places(spark, path) - rollups.stored(spark, path)
    if missing:
        places = [
            f"{path}/created_date={day}/stream_id={COMPACTED}/batch_id={version}"
            for day, version in sorted(missing)
        ]
        rows = spark.read.schema(STORED).option("basePath", path).parquet(*places)
        rollups.store(rows.withColumnRenamed("batch_id", "version"), path)
    return len(missing)


def _compacted_places(spark: SparkSession, path: str) -> set[tuple[date, int]]:
    """Day and version of the compacted folders that count: one per day and compaction."""
    rows = _listed(spark, path).select("created_date", "version").distinct().collect()
    return {(r["created_date"], r["version"]) for r in rows}


@dataclass(frozen=True)
class Split:
    """A table as days that are read shot by shot and folders that are read rolled up."""

    open_days: list[date]
    rolled: set[tuple[date, int]]


def split_days(spark: SparkSession, path: str) -> Split:
    """Which days need their shots read: those with a batch that no compaction has taken, or
    with a compacted folder that is not rolled up. Found by the names of files alone."""
    path = path.rstrip("/")
    upto: dict[tuple[date, str], int] = {}
    for r in _listed(spark, path).groupBy("created_date", "stream_id").agg(
        F.max("upto").alias("upto")
    ).collect():
        upto[r["created_date"], r["stream_id"]] = r["upto"]
    compacted = _compacted_places(spark, path)
    rolled = compacted & rollups.stored(spark, path)
    open_days = {day for day, _ in compacted - rolled}
    if stored_days(spark, path):
        for file in _stored(spark, path).inputFiles():
            day, stream, batch = (unquote(part.split("=", 1)[1]) for part in file.split("/")[-4:-1])
            day, batch = date.fromisoformat(day), int(batch)
            if stream != COMPACTED and batch > upto.get((day, stream), -1):
                open_days.add(day)
    return Split(sorted(open_days), {p for p in rolled if p[0] not in open_days})


def read_days(spark: SparkSession, path: str, days: Sequence[date]) -> DataFrame:
    """Stored rows of those days."""
    return _current(spark, path, days).select(*TELEMETRY.fieldNames())


def zone_sums_of_all_time(spark: SparkSession, path: str, split: Split) -> DataFrame:
    """``analytics.zone_sums`` of the table: roll-ups, and the shots of open days."""
    parts = A.zone_sums(read_days(spark, path, split.open_days)).unionByName(
        rollups.read(spark, path, rollups.ZONES, split.rolled).select(
            "zone", "shot_grade", "shots", "points", "scored", "nearest"
        )
    )
    return parts.groupBy("zone", "shot_grade").agg(
        *[F.sum(c).alias(c) for c in ("shots", "points", "scored")],
        F.min("nearest").alias("nearest"),
    )


def player_sums_of_all_time(spark: SparkSession, path: str, split: Split) -> DataFrame:
    """``analytics.player_sums`` by parts of the table: roll-ups, and the shots of open days."""
    return A.player_sums(read_days(spark, path, split.open_days)).unionByName(
        rollups.read(spark, path, rollups.PLAYERS, split.rolled).select(
            "player_name", "shots", "points", "scored"
        )
    )


def _upto(listed: DataFrame, day: date) -> DataFrame:
    own = listed.where(F.col("created_date") == F.lit(day))
    return own.groupBy("stream_id").agg(F.max("upto").alias("upto"))


def read_telemetry(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """Stored rows with both times. ``since`` limits by created_at and lists only its days."""
    if since is None:
        return _current(spark, path).select(*TELEMETRY.fieldNames())
    # a day more: the date of ``since`` depends on the session's time zone
    first = since.date() - timedelta(days=1)
    rows = _current(spark, path, [d for d in stored_days(spark, path) if d >= first])
    return rows.where(F.col("created_at") >= F.lit(since)).select(*TELEMETRY.fieldNames())


def read_newest_days(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The newest whole days that hold at least ``n`` rows together, or all days.

    What is newest overall is newest in there, so a "latest n" report need not
    read, or list, the rest of the table.
    """
    days = stored_days(spark, path)
    for span in (1, 7, 31, 366) if days else ():
        recent = [d for d in days if d > days[-1] - timedelta(days=span)]
        rows = _current(spark, path, recent)
        if rows.limit(n).count() == n:
            return rows.select(*TELEMETRY.fieldNames())
    return read_telemetry(spark, path)


JDBC_KEY = "id"
ROWS_PER_READ = 1_000_000


def read_telemetry_jdbc(
    spark: SparkSession, url: str, table: str, rows_per_read: int = ROWS_PER_READ, **options: str
) -> DataFrame:
    """Telemetry from a database, read by ranges of its serial key in parallel.

    The key's least and largest values come first, from a query that the database answers
    by its index. Filters and column choice are pushed to the database too. Options that
    name a partitionColumn are used as they are.
    """
    if "partitionColumn" not in options:
        ends = spark.read.format("jdbc").options(
            url=url, dbtable=key_ends_query(table), **options
        ).load().first()
        options |= key_ranges(ends[0], ends[1], rows_per_read)
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return scan_telemetry(rows.withColumn("shot_id", F.col(JDBC_KEY).cast("string")))


def key_ends_query(table: str) -> str:
    """A subquery with the least and the largest key of a table, in place of its name."""
    return f"(SELECT MIN({JDBC_KEY}) AS least, MAX({JDBC_KEY}) AS most FROM {table}) AS ends"


def key_ranges(least: int | None, most: int | None, rows_per_read: int) -> dict[str, str]:
    """Options that cut a read into equal ranges of the key, one for about so many rows.

    None for an empty table, or one that a single range holds: a plain read does.
    """
    if least is None or most - least < rows_per_read:
        return {}
    count = -(-(most - least + 1) // rows_per_read)
    return {
        "partitionColumn": JDBC_KEY,
        "lowerBound": str(least),
        "upperBound": str(most + 1),
        "numPartitions": str(count),
    }


def scan_telemetry(telemetry: DataFrame) -> DataFrame:
    """The seven reported columns."""
    return telemetry.select(*TELEMETRY_COLUMNS)
