"""Job: score the event stream into the telemetry table until stopped."""

from __future__ import annotations

import argparse

from swishline.plans.options import add_transport, transport_of
from swishline.session import get_session
from swishline.sources.events import EARLIEST, LATEST, subscribe_events
from swishline.sources.telemetry import append_telemetry, append_telemetry_jdbc
from swishline.streaming.enrich import Scorer, skip_history, stream_enrich


# a history that is replayed from its start must not be one micro-batch
MAX_PER_TRIGGER = {"kafka": 5_000_000, "files": 500}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_transport(parser)
    parser.add_argument("--artifacts", nargs="+", required=True, help="roots, tried in order")
    parser.add_argument("--telemetry", required=True, help="telemetry table folder")
    parser.add_argument("--jdbc-url", help="store in a database instead of the folder")
    parser.add_argument("--jdbc-table", default="shot_telemetry")
    parser.add_argument("--rejects", help="folder for unreadable messages")
    parser.add_argument("--checkpoint", required=True, help="the same one resumes after a stop")
    parser.add_argument("--start", choices=[EARLIEST, LATEST], default=LATEST)
    parser.add_argument(
        "--max-per-trigger", type=int, help="records (Kafka) or files in a micro-batch"
    )
    parser.add_argument("--once", action="store_true", help="take what is there, then stop")
    args = parser.parse_args(argv)

    spark = get_session("score")
    checkpoint = args.checkpoint
    transport = transport_of(args)
    bound = args.max_per_trigger or MAX_PER_TRIGGER[transport.kind]
    if args.start == LATEST and transport.kind == "files":
        skip_history(subscribe_events(spark, transport), checkpoint)
    sink = append_telemetry
    if args.jdbc_url:
        def sink(batch, path, batch_id, stream_id):
            append_telemetry_jdbc(batch, args.jdbc_url, args.jdbc_table)

    query = stream_enrich(
        subscribe_events(spark, transport, args.start, bound),
        Scorer(spark, args.artifacts),
        args.telemetry,
        args.rejects or f"{args.telemetry.rstrip('/')}_rejects",
        checkpoint,
        trigger={"availableNow": True} if args.once else None,
        sink=sink,
    )
    query.awaitTermination()


if __name__ == "__main__":
    main()
