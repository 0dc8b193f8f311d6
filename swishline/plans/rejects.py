"""Job: gather the messages that could not be read, or try them again once mended."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from swishline.session import get_session
from swishline.sources.rejects import compact_rejects, replay_rejects
from swishline.streaming.enrich import Scorer


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--rejects", required=True, help="folder of unreadable messages")
    parser.add_argument("--mend", help="SQL expression that makes a readable text of `value`")
    parser.add_argument("--telemetry", help="table that the mended ones go to")
    parser.add_argument("--artifacts", nargs="+", default=[], help="roots, tried in order")
    args = parser.parse_args(argv)
    if bool(args.mend) != bool(args.telemetry):
        parser.error("--mend and --telemetry go together")

    spark = get_session("rejects")
    if args.mend:
        scorer = Scorer(spark, args.artifacts)
        left = replay_rejects(
            spark, args.rejects, lambda value: F.expr(args.mend), scorer.score, args.telemetry
        )
    else:
        left = compact_rejects(spark, args.rejects)
    print(f"unreadable: {left}")


if __name__ == "__main__":
    main()
