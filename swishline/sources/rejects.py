"""Messages that could not be read: kept by batch, compacted, and replayed once mended.

``<path>/stream_id=<s>/batch_id=<n>`` holds a micro-batch's rejects. ``<path>_log`` lists
generations: up to which batch of each stream a generation has taken rejects. A generation
is a compaction or a replay: what it leaves unread is stored once more, in large files,
below ``stream_id=left/batch_id=<generation>``. Readers take the newest generation's
folder and later batches; the next generation removes what the one before it has replaced.

A replay first lists what it takes and its time, as begun; then it stores telemetry, in a
folder that only this generation writes, and what is left; then it is listed as done. One
that is interrupted is begun again with the same list and time, and replaces whatever
its first run has stored, so a reject that is mended counts once.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swishline.operators.plays import decode_events, is_readable, readable
from swishline.sources import files
from swishline.sources.scratch import written
from swishline.sources.telemetry import append_telemetry

REJECTS = "shot_id string, value string, stream_id string, batch_id bigint"
LOG = "generation bigint, stream_id string, upto bigint, at double, done boolean"
LEFT, MENDED = "left", "mended"


def _log(spark: SparkSession, path: str) -> DataFrame:
    folder = f"{path}_log"
    if not files.is_there(spark, folder):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(folder)


def _list(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{path}_log")


def _generation(spark: SparkSession, path: str, done: bool) -> tuple[int, dict[str, int], float]:
    """The newest generation that is done, or only begun: number, batches taken, time."""
    rows = _log(spark, path).collect()  # a row per stream and generation
    finished = max((r["generation"] for r in rows if r["done"]), default=-1)
    own = finished if done else finished + 1
    taken = {r["stream_id"]: r["upto"] for r in rows if r["generation"] == own and not r["done"]}
    at = max((r["at"] for r in rows if r["generation"] == own), default=0.0)
    return own, taken, at


def _stored(spark: SparkSession, path: str) -> DataFrame:
    if not files.folders(spark, path):
        return spark.createDataFrame([], REJECTS)
    return spark.read.schema(REJECTS).option("basePath", path).parquet(path)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Messages that no replay has mended yet: shot_id, value, stream_id, batch_id."""
    path = path.rstrip("/")
    number, taken, _ = _generation(spark, path, done=True)
    return _open(_stored(spark, path), number, taken)


def _open(rows: DataFrame, number: int, taken: dict[str, int]) -> DataFrame:
    """Of the stored rejects: what that generation has left, and the batches after it."""
    left = (F.col("stream_id") == LEFT) & (F.col("batch_id") == number)
    upto = F.lit(-1)
    for stream, batch in taken.items():  # one per stream
        upto = F.when(F.col("stream_id") == stream, batch).otherwise(upto)
    return rows.where(left | ((F.col("stream_id") != LEFT) & (F.col("batch_id") > upto)))


def _batches(spark: SparkSession, path: str) -> dict[str, int]:
    """The newest batch of each stream that has rejects."""
    found = {}
    for stream in files.values(spark, path, "stream_id"):
        batches = files.values(spark, f"{path}/stream_id={stream}", "batch_id")
        if stream != LEFT and batches:
            found[stream] = max(map(int, batches))
    return found


def compact_rejects(spark: SparkSession, path: str) -> int:
    """Gather all open rejects into large files; returns how many there are."""
    return _next_generation(spark, path.rstrip("/"), lambda rows, number, at: rows)


def replay_rejects(
    spark: SparkSession,
    path: str,
    mend: Callable[[Column], Column],
    score: Callable[[DataFrame, Column], DataFrame],
    telemetry_path: str,
) -> int:
    """Try the open rejects again with ``mend`` applied to their text.

    Those that can be read then are scored (``score`` takes events and the time of storage,
    as ``Scorer.score`` does) and stored; the others stay rejects, with their old text.
    Returns how many are left. Call it from one place at a time.
    """

    def store(rows: DataFrame, number: int, at: float) -> DataFrame:
        tried = rows.select("shot_id", mend(F.col("value")).alias("value"), F.col("value").alias("old"),
                            "stream_id", "batch_id")
        decoded = decode_events(tried)
        events = readable(decoded.drop("old", "stream_id", "batch_id"))
        stamp = F.lit(datetime.fromtimestamp(at, UTC))
        # a first run may have stored rows that this one does not
        day = datetime.fromtimestamp(at, UTC).date()
        for name in files.values(spark, telemetry_path.rstrip("/"), "created_date"):
            if abs((datetime.fromisoformat(name).date() - day).days) <= 1:
                folder = f"created_date={name}/stream_id={MENDED}/batch_id={number}"
                files.remove(spark, f"{telemetry_path.rstrip('/')}/{folder}")
        append_telemetry(score(events, stamp), telemetry_path, number, MENDED)
        still = decoded.where(~is_readable())
        return still.select("shot_id", F.col("old").alias("value"), "stream_id", "batch_id")

    return _next_generation(spark, path.rstrip("/"), store)


def _next_generation(
    spark: SparkSession, path: str, step: Callable[[DataFrame, int, float], DataFrame]
) -> int:
    before, known, _ = _generation(spark, path, done=True)
    number, taken, at = _generation(spark, path, done=False)
    _remove_replaced(spark, path, before, known)
    if not taken:
        taken, at = known | _batches(spark, path), time.time()
        if not taken:
            return 0
        _list(spark, path, [(number, s, upto, at, False) for s, upto in taken.items()])
    rows = _open(_stored(spark, path), before, known)
    upto = F.lit(-1)
    for stream, batch in taken.items():
        upto = F.when(F.col("stream_id") == stream, batch).otherwise(upto)
    # batches that came after this generation began are for the next
    rows = written(rows.where((F.col("stream_id") == LEFT) | (F.col("batch_id") <= upto)), "rejects")
    left = step(rows, number, at).select("shot_id", "value")
    folder = f"{path}/stream_id={LEFT}/batch_id={number}"
    # adaptive execution cuts many rejects into several well-sized files
    left.hint("rebalance").write.mode("overwrite").parquet(folder)
    _list(spark, path, [(number, LEFT, number, at, True)])
    return spark.read.schema("shot_id string, value string").parquet(folder).count()


def _remove_replaced(spark: SparkSession, path: str, number: int, taken: dict[str, int]) -> None:
    """Remove what the generation that is done has replaced: readers had since then to finish."""
    for stream in files.values(spark, path, "stream_id"):
        upto = number - 1 if stream == LEFT else taken.get(stream, -1)
        folder = f"{path}/stream_id={stream}"
        for batch in map(int, files.values(spark, folder, "batch_id")):
            if batch <= upto:
                files.remove(spark, f"{folder}/batch_id={batch}")
