"""Job: keep the per-minute and headline reports current from the event stream.

New models and ratings are taken up while the job runs: shots are scored by the newest
versions that the scorer has found when their micro-batch begins.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from swishline.operators.plays import decode_events, readable
from swishline.operators.scoring import event_time
from swishline.plans.options import add_transport, print_all, transport_of
from swishline.session import get_session
from swishline.sources.events import EARLIEST, LATEST, subscribe_events
from swishline.streaming.enrich import Scorer
from swishline.streaming.live import (
    LATE_BY,
    REFRESH,
    grades,
    headline,
    late_rows,
    running_totals_now,
    shots_per_minute_now,
    stream_live_totals,
    stream_shots_per_minute,
    zones,
)


def show(spark: SparkSession, out: str) -> None:
    """Print the reports that the running job keeps below ``out``."""
    totals = running_totals_now(spark, f"{out.rstrip('/')}/totals")
    minutes = shots_per_minute_now(spark, f"{out.rstrip('/')}/minutes")
    last_hour = minutes.orderBy(F.col("minute").desc()).limit(60)
    named = (("headline", headline(totals)), ("grades", grades(totals)), ("zones", zones(totals)))
    for name, report in (*named, ("last 60 minutes", last_hour)):
        print(name)
        print_all(report)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_transport(parser)
    parser.add_argument("--artifacts", nargs="+", default=[], help="roots, tried in order")
    parser.add_argument("--out", required=True, help="folder of the reports")
    parser.add_argument("--checkpoint", help="the same one resumes after a stop")
    parser.add_argument("--show", action="store_true", help="print the reports as they stand")
    parser.add_argument("--start", choices=[EARLIEST, LATEST], default=LATEST)
    parser.add_argument("--late-by", default=LATE_BY, help="how late an event still counts")
    parser.add_argument("--once", action="store_true", help="take what is there, then stop")
    args = parser.parse_args(argv)
    if args.show:
        show(get_session("live"), args.out)
        return
    if not args.checkpoint:
        parser.error("--checkpoint is needed")
    if args.start == LATEST and args.transport == "files":
        parser.error("reports over files start at the earliest message")

    spark = get_session("live")
    transport = transport_of(args)
    offsets = {name: f"{args.checkpoint.rstrip('/')}/{name}" for name in ("minutes", "totals")}
    messages = subscribe_events(spark, transport, args.start)
    events = readable(decode_events(messages))
    out = args.out.rstrip("/")
    trigger = {"availableNow": True} if args.once else REFRESH
    queries = [
        stream_shots_per_minute(
            events.withColumn("event_time", event_time()),
            f"{out}/minutes",
            offsets["minutes"],
            trigger,
            args.late_by,
        ),
        stream_live_totals(
            events, Scorer(spark, args.artifacts), f"{out}/totals", offsets["totals"], trigger
        ),
    ]
    for query in queries:
        query.awaitTermination()
    if args.once:
        print(f"late: {late_rows(queries[0], f'{out}/minutes')}")


if __name__ == "__main__":
    main()
