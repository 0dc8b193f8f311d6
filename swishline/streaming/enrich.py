"""The streaming scorer: messages in, telemetry out, artifacts reloaded on the way."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import cache

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from swishline.operators.lookup import RatingTable
from swishline.operators.plays import decode_events, is_readable, readable, unreadable
from swishline.operators.scoring import score_events
from swishline.schemas import RELOAD_SECONDS
from swishline.sources.artifacts import Version, load_model, load_ratings
from swishline.sources.telemetry import append_telemetry, batch_folder
from swishline.streaming.checkpoints import stream_id

log = logging.getLogger(__name__)

# every trigger leaves files in the table: not more often than its readers need
TRIGGER = {"processingTime": "10 seconds"}


class Scorer:
    """Current model and ratings, looked up anew at most once per interval.

    A look-up that finds nothing newer, or fails, keeps what is there. With no
    model at all, shots get the heuristic.
    """

    def __init__(
        self,
        spark: SparkSession,
        artifact_roots: Sequence[str],
        reload_seconds: float = RELOAD_SECONDS,
        clock: Callable[[], float] = time.monotonic,
    ) -> None:
        self._spark = spark
        self._roots = list(artifact_roots)
        self._reload_seconds = reload_seconds
        self._clock = clock
        self.model: PipelineModel | None = None
        self.ratings: RatingTable | None = None
        self.model_version: Version | None = None
        self.ratings_version: Version | None = None
        self._load()

    def refresh(self) -> None:
        if self._clock() - self._checked > self._reload_seconds:
            self._load()

    def _load(self) -> None:
        found = load_model(self._spark, self._roots, self.model_version)
        if found is not None:
            self.model_version, self.model = found
        found = load_ratings(self._spark, self._roots, self.ratings_version)
        if found is not None:
            if self.ratings is not None:
                self.ratings.frame.unpersist()
            # read by every micro-batch: kept until newer ones come
            version, table = found
            self.ratings_version, self.ratings = version, replace(table, frame=table.frame.persist())
        if self.model is None:
            log.warning("no model found: scoring by the heuristic")
        self._checked = self._clock()

    def score(self, events: DataFrame, created_at: Column | None = None) -> DataFrame:
        return score_events(events, self.model, self.ratings, created_at)


def stream_enrich(
    messages: DataFrame,
    scorer: Scorer,
    telemetry_path: str,
    rejects_path: str,
    checkpoint: str,
    created_at: Column | None = None,
    trigger: dict | None = None,
    sink: Callable[[DataFrame, str, int, str], None] = append_telemetry,
) -> StreamingQuery:
    """Start scoring a stream of ``shot_id`` and ``value``.

    The stream's checkpoint holds the offsets and the time of each micro-batch, which
    is the time of storage unless ``created_at`` sets another; so a micro-batch that has
    to run again, even after midnight, replaces what its first run stored. Messages that cannot be read are
    stored apart, with their text, and do not stop the stream. They are counted
    while the good ones are stored, so a batch without any is read only once.
    """

    at_batch = created_at is None

    @cache
    def own_id() -> str:
        return stream_id(messages.sparkSession, checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        scorer.refresh()
        decoded = decode_events(batch)
        # observed in the micro-batch's own session: a session that has observed
        # anything can no longer ship Spark ML models that were made in it
        seen = Observation()
        counted = decoded.observe(seen, F.count_if(~is_readable()).alias("unreadable"))
        scored = scorer.score(readable(counted), F.col("taken_at") if at_batch else created_at)
        sink(scored, telemetry_path, batch_id, own_id())
        if _any_unreadable(seen):
            rejects = unreadable(decoded).drop("taken_at")
            rejects.write.mode("overwrite").parquet(batch_folder(rejects_path, own_id(), batch_id))

    # on a stream this is the logged time of the micro-batch, the same when it runs again
    taken = messages.withColumn("taken_at", F.current_timestamp()) if at_batch else messages
    writer = taken.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or TRIGGER)).start()


def _any_unreadable(seen: Observation) -> bool:
    """What the observation has counted. Of a batch without one readable message nothing is
    stored, and adaptive execution may drop its plan together with the count: then yes."""
    try:
        return bool(seen.get["unreadable"])
    except Py4JJavaError:
        return True


def skip_history(messages: DataFrame, checkpoint: str) -> None:
    """Mark everything published so far as taken, without reading it.

    For sources that have no "latest" start position, such as files: call this,
    then start the real query, one without state, on the same checkpoint. A checkpoint that is in use
    already is left alone, so a stopped query resumes where it was.
    """
    if stream_id(messages.sparkSession, checkpoint) is not None:
        return
    query = (
        messages.writeStream.foreachBatch(lambda batch, batch_id: None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
