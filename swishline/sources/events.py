"""The shot-event stream: JSON messages on Kafka or as text files.

Both transports offer the same four things: publish, subscribe, a bound on how
much one trigger takes, and a start position. Kafka needs its connector package
on the cluster; the file transport needs only a shared folder.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swishline.operators.plays import EVENT_KEY, encode_events
from swishline.schemas import EVENT_TOPIC
from swishline.sources import files
from swishline.sources.scratch import scratch_dir

EARLIEST, LATEST = "earliest", "latest"


@dataclass(frozen=True)
class Transport:
    """Where messages travel. ``location`` is a folder or a Kafka bootstrap list."""

    kind: str  # "files" or "kafka"
    location: str
    topic: str = EVENT_TOPIC
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in ("files", "kafka"):
            raise ValueError(f"unknown transport {self.kind!r}")

    @property
    def path(self) -> str:
        return f"{self.location.rstrip('/')}/{self.topic}"


def publish_events(events: DataFrame, to: Transport) -> None:
    """Append one JSON message per event. Messages carry no key, so a busy game
    or player spreads over all partitions of the topic."""
    messages = encode_events(events)
    if to.kind == "kafka":
        writer = messages.write.format("kafka").option("topic", to.topic)
        writer = writer.option("kafka.bootstrap.servers", to.location)
        writer.options(**to.options).save()
    else:
        messages.write.mode("append").options(**to.options).text(to.path)


def publish_history(
    events: DataFrame, to: Transport, count: int, order: str = "timestamp"
) -> list[str]:
    """Append events as ``count`` files of consecutive ranges of their time, oldest first.

    A subscriber takes files in the order of their modification times, so with a bound
    on files per trigger a replay sees history in order: no event of a micro-batch is
    older than those of the batch before, and none is late for a watermark. Files are
    written together, get times that follow each other and the files that are there, and
    only then appear in the stream. Events without a time come first. Returns the names.

    For files only: a topic of several partitions keeps no order over all of them. A store
    that does not keep given times is refused before anything is published.
    """
    if to.kind != "files":
        raise ValueError("history keeps its order in files only")
    spark = events.sparkSession
    staged = scratch_dir(spark, "history")
    ranges = events.repartitionByRange(count, order).sortWithinPartitions(order)
    encode_events(ranges).write.options(**to.options).text(staged)
    # the number of a range grows with time and stands at the head of the file's name
    names = sorted(files.names(spark, staged), key=lambda n: (len(n), n))
    begin = max(time.time_ns() // 1_000_000 - len(names), files.last_time(spark, to.path) + 1)
    for i, name in enumerate(names):
        if not files.move_at(spark, f"{staged}/{name}", f"{to.path}/{name}", begin + i):
            raise ValueError(f"{to.location} does not keep the times given to files")
    return names


def read_messages(spark: SparkSession, source: Transport) -> DataFrame:
    """All messages published so far, as a batch."""
    if source.kind == "kafka":
        raw = _kafka(spark.read, source).option("startingOffsets", EARLIEST).load()
    else:
        raw = spark.read.options(**source.options).text(source.path)
    return _keyed(raw, source)


def subscribe_events(
    spark: SparkSession,
    source: Transport,
    start: str = LATEST,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Messages as a stream of ``shot_id`` and ``value``.

    ``max_per_trigger`` bounds a micro-batch: records for Kafka, files for files.
    The file source always begins with the files there are; see
    ``streaming.enrich.skip_history`` for starting at the latest.
    """
    if source.kind == "kafka":
        reader = _kafka(spark.readStream, source).option("startingOffsets", start)
        limit_option = "maxOffsetsPerTrigger"
    else:
        reader = spark.readStream.format("text").options(**source.options)
        limit_option = "maxFilesPerTrigger"
    if max_per_trigger is not None:
        reader = reader.option(limit_option, max_per_trigger)
    raw = reader.load() if source.kind == "kafka" else reader.load(source.path)
    return _keyed(raw, source)


def _kafka(reader, source: Transport):
    reader = reader.format("kafka").option("kafka.bootstrap.servers", source.location)
    return reader.option("subscribe", source.topic).options(**source.options)


def _keyed(raw: DataFrame, source: Transport) -> DataFrame:
    value = F.col("value").cast("string")
    return raw.select(_message_key(source, value).alias("shot_id"), value.alias("value"))


def _message_key(source: Transport, value: Column) -> Column:
    """The message's own identity, in place of a serial number.

    Files have no offsets: the key that the publisher gave, or else the text's hash, which
    equal messages share.
    """
    if source.kind == "kafka":
        return F.concat_ws("-", F.col("topic"), F.col("partition"), F.col("offset"))
    return F.coalesce(F.get_json_object(value, f"$.{EVENT_KEY}"), F.md5(value))
