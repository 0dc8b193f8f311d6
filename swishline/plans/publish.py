"""Job: turn a play-by-play CSV into shot events on the stream."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from swishline.operators.plays import EVENT_KEY, build_event
from swishline.plans.options import add_transport, transport_of
from swishline.session import get_session
from swishline.sources.events import Transport, publish_events
from swishline.sources.plays import scan_plays


def publish(spark: SparkSession, plays_path: str, to: Transport) -> None:
    """Every play gets a key of its own, so that equal plays stay two events."""
    events = build_event(scan_plays(spark, plays_path)).withColumn(EVENT_KEY, F.uuid())
    publish_events(events, to)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--plays", required=True, help="CSV file or folder")
    add_transport(parser)
    args = parser.parse_args(argv)
    publish(get_session("publish"), args.plays, transport_of(args))


if __name__ == "__main__":
    main()
