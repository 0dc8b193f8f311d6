"""Command-line options that several jobs share."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from swishline.schemas import EVENT_TOPIC
from swishline.sources.events import Transport


def add_transport(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--transport", choices=["kafka", "files"], default="kafka")
    parser.add_argument("--location", required=True, help="bootstrap servers, or a shared folder")
    parser.add_argument("--topic", default=EVENT_TOPIC)


def transport_of(args: argparse.Namespace) -> Transport:
    return Transport(args.transport, args.location, args.topic)


def print_all(report: DataFrame) -> None:
    """All rows of a report: reports are bounded, but not by the 20 rows that show() prints."""
    report.show(max(1, report.count()), truncate=False)
