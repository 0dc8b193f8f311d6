"""Job: every table behind the dashboard, from one telemetry table."""

from __future__ import annotations

import argparse
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swishline.operators import analytics as A
from swishline.operators.sampling import SAMPLE_LIMIT, latest_n, recent_shots, sample_n
from swishline.plans.options import print_all
from swishline.session import get_session
from swishline.sources.telemetry import (
    player_sums_of_all_time,
    read_newest_days,
    read_telemetry,
    split_days,
    zone_sums_of_all_time,
)
from swishline.streaming import live


def refresh(
    telemetry: DataFrame,
    as_of: datetime | None = None,
    sample: int = SAMPLE_LIMIT,
) -> dict[str, DataFrame]:
    """Report name to frame.

    Header, grades and zones follow from one count by zone and grade, of at most 15 rows;
    the leaderboard is the other pass over the table. The latest-n sample (at most 5000
    rows) is found once and kept for the reports drawn from it.
    """
    latest = latest_n(telemetry, sample).persist()
    facts = A.sample_facts(latest)
    now = facts["newest"] if as_of is None else F.lit(as_of)
    totals = A.zone_grades(telemetry, now)
    players, per_minute = A.player_leaderboard(telemetry), A.shots_per_minute(telemetry, as_of)
    return _reports(totals, latest, players, per_minute)


def _reports(
    totals: DataFrame, latest: DataFrame, players: DataFrame, per_minute: DataFrame
) -> dict[str, DataFrame]:
    totals = totals.persist()
    return {
        "header": A.header(totals, A.sample_facts(latest)["three_point_pct"]),
        "grades": live.grades(totals),
        "zones": live.zones(totals),
        "players": players,
        "per_minute": per_minute,
        "shot_map": A.shot_position(sample_n(latest)),
        "distances": A.distance_histogram(latest),
        "xp_by_distance": A.xp_by_distance(latest),
        "recent": recent_shots(latest),
    }


def refresh_stored(
    spark: SparkSession, path: str, as_of: datetime, sample: int = SAMPLE_LIMIT
) -> dict[str, DataFrame]:
    """The reports of a stored table.

    Sums over all time come from the roll-ups of days that are over and the shots of the
    others; the timed reports and the sample read only the newest days they need. So a
    refresh costs what the open days hold, however many years lie behind them.
    """
    split = split_days(spark, path)
    latest = latest_n(read_newest_days(spark, path, sample), sample).persist()
    last_hour = read_telemetry(spark, path, as_of - timedelta(hours=1))
    recent = A.recent_activity(last_hour, as_of).scalar()
    totals = zone_sums_of_all_time(spark, path, split)
    # the header sums over zones and grades: a row without shots carries the recent ones
    carried = spark.range(1).select(recent.alias("recent_shots"))
    totals = totals.withColumn("recent_shots", F.lit(0).cast("bigint"))
    players = A.busiest(player_sums_of_all_time(spark, path, split))
    per_minute = A.shots_per_minute(last_hour, as_of)
    reports = _reports(totals, latest, players, per_minute)
    threes = A.sample_facts(latest)["three_point_pct"]
    with_recent = totals.unionByName(carried, allowMissingColumns=True)
    return {**reports, "header": A.header(with_recent, threes)}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--telemetry", required=True, help="telemetry table folder")
    parser.add_argument("--sample", type=int, default=SAMPLE_LIMIT)
    parser.add_argument("--out", help="folder to store the reports in, instead of printing")
    parser.add_argument(
        "--as-of", type=datetime.fromisoformat, help="report as at this time, not as of now"
    )
    args = parser.parse_args(argv)

    spark = get_session("dashboard")
    as_of = (args.as_of or datetime.now()).astimezone()
    reports = refresh_stored(spark, args.telemetry, as_of, args.sample)
    for name, report in reports.items():
        if args.out:
            report.write.mode("overwrite").json(f"{args.out.rstrip('/')}/{name}")
        else:
            print(name)
            print_all(report)


if __name__ == "__main__":
    main()
