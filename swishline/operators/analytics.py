"""Dashboard reports over telemetry.

Every aggregate combines on the map side, so a hot player, zone or minute costs
one row per task. Times are relative to ``as_of``: a fixed time, which reaches
the scan as a filter, or the newest stored time when the caller gives none.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swishline.functions import shots as S
from swishline.operators.sampling import SAMPLE_LIMIT, latest_n
from swishline.schemas import GRADE_LABELS

TOP_PLAYERS = 10
HISTOGRAM_BINS = 25


def _rows() -> Column:
    return F.count(F.lit(1))


def _percent(share: Column) -> Column:
    """A 0..1 share as a percentage, 0 where there are no rows."""
    return F.coalesce(100 * share, F.lit(0.0))


def _share_of(condition: Column) -> Column:
    return F.try_divide(F.count_if(condition).cast("double"), _rows())


def _as_of(telemetry: DataFrame, as_of: datetime | None) -> Column:
    if as_of is not None:
        return F.lit(as_of)
    return telemetry.agg(F.max("created_at")).scalar()


def _within(telemetry: DataFrame, as_of: datetime | None, minutes: int) -> Column:
    return F.col("created_at") >= _as_of(telemetry, as_of) - F.expr(f"INTERVAL {minutes} MINUTES")


def shot_zone(telemetry: DataFrame) -> DataFrame:
    return telemetry.withColumn("zone", S.zone(F.col("shot_distance")))


def shot_position(telemetry: DataFrame) -> DataFrame:
    """Court coordinates: the distance is real, the angle a hash of the key."""
    angle = S.court_angle(F.col("shot_id"))
    return telemetry.withColumns(
        {
            "x": S.court_x(F.col("shot_distance"), angle),
            "y": S.court_y(F.col("shot_distance"), angle),
        }
    )


def total_shots(telemetry: DataFrame) -> DataFrame:
    return telemetry.agg(_rows().alias("total_shots"))


def avg_xp(telemetry: DataFrame) -> DataFrame:
    return telemetry.agg(F.coalesce(F.avg("expected_points"), F.lit(0.0)).alias("avg_xp"))


def grade_distribution(telemetry: DataFrame) -> DataFrame:
    """Shots and percent of all shots for the three grades, absent ones as 0."""
    return grade_distribution_of(telemetry, F.lit(1))


def grade_distribution_of(rows: DataFrame, weight: Column) -> DataFrame:
    """Grade distribution where a row stands for ``weight`` shots.

    One conditional sum per grade in a single aggregate, then turned to rows.
    """

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("bigint")

    counts = rows.agg(
        *[total(F.col("shot_grade") == g).alias(g) for g in GRADE_LABELS],
        total(F.lit(True)).alias("total"),
    )
    as_rows = F.array(
        *[
            F.struct(F.lit(g).alias("grade"), F.lit(label).alias("label"), F.col(g).alias("shots"))
            for g, label in GRADE_LABELS.items()
        ]
    )
    grades = counts.select("total", F.inline(as_rows))
    percent = _percent(F.try_divide(F.col("shots").cast("double"), F.col("total")))
    return grades.select("grade", "label", "shots", percent.alias("percent"))


def player_leaderboard(telemetry: DataFrame, n: int = TOP_PLAYERS) -> DataFrame:
    """Busiest players; equal counts are ordered by name."""
    return busiest(player_sums(telemetry), n)


def player_sums(telemetry: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Shots, points and shots with points per player (and ``by``): sums that add up."""
    return telemetry.groupBy(*by, "player_name").agg(
        _rows().alias("shots"),
        F.sum("expected_points").alias("points"),
        F.count("expected_points").alias("scored"),
    )


def busiest(sums: DataFrame, n: int = TOP_PLAYERS) -> DataFrame:
    """The leaderboard from ``player_sums`` of one or several parts."""
    players = sums.groupBy("player_name").agg(
        F.sum("shots").alias("shots"),
        F.try_divide(F.sum("points"), F.sum("scored")).alias("avg_xp"),
    )
    return players.orderBy(F.col("shots").desc(), "player_name").limit(n)


def zone_stats(telemetry: DataFrame) -> DataFrame:
    """Shots and mean expected points per zone, nearest zone first, unknown distances last."""
    zones = shot_zone(telemetry).groupBy("zone").agg(
        _rows().alias("shots"),
        F.avg("expected_points").alias("avg_xp"),
        F.min("shot_distance").alias("nearest"),
    )
    return zones.orderBy(F.col("nearest").asc_nulls_last()).select("zone", "shots", "avg_xp")


def recent_activity(
    telemetry: DataFrame, as_of: datetime | None = None, minutes: int = 5
) -> DataFrame:
    recent = telemetry.where(_within(telemetry, as_of, minutes))
    return recent.agg(_rows().alias("recent_shots"))


def shots_per_minute(
    telemetry: DataFrame, as_of: datetime | None = None, minutes: int = 60
) -> DataFrame:
    """Shots per minute over the trailing hour; empty minutes are absent."""
    recent = telemetry.where(_within(telemetry, as_of, minutes))
    per_minute = recent.groupBy(F.date_trunc("minute", "created_at").alias("minute"))
    return per_minute.agg(_rows().alias("shots")).orderBy("minute")


def premium_pct(telemetry: DataFrame) -> DataFrame:
    share = _share_of(F.col("shot_grade") == "A")
    return telemetry.agg(_percent(share).alias("premium_pct"))


def three_point_pct(telemetry: DataFrame, sample: int = SAMPLE_LIMIT) -> DataFrame:
    """Share of threes among the newest shots only, as the dashboard shows it."""
    share = _share_of(S.beyond_arc(F.col("shot_distance")))
    return latest_n(telemetry, sample).agg(_percent(share).alias("three_point_pct"))


def distance_histogram(rows: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Shots per distance bin: whole-foot bins of equal width, at most ``bins``.

    Rows collapse to one count per distance first; the range and the bins are
    both read from those counts.
    """
    counts = rows.groupBy("shot_distance").agg(_rows().alias("n"))
    low = counts.agg(F.min("shot_distance")).scalar()
    high = counts.agg(F.max("shot_distance")).scalar()
    width = F.ceil((high - low + 1) / bins).cast("int")
    start = low + F.floor((F.col("shot_distance") - low) / width).cast("int") * width
    binned = counts.groupBy(start.alias("bin_start"), width.alias("bin_width"))
    return binned.agg(F.sum("n").alias("shots")).orderBy("bin_start")


def xp_by_distance(rows: DataFrame) -> DataFrame:
    """Shots and mean expected points per distance and grade."""
    points = rows.groupBy("shot_distance", "shot_grade")
    return points.agg(_rows().alias("shots"), F.avg("expected_points").alias("avg_xp"))


def sample_facts(latest: DataFrame) -> Column:
    """Newest time and share of threes of the latest-n sample, as one scalar: however often
    a query uses it, the sample is taken once."""
    threes = _percent(_share_of(S.beyond_arc(F.col("shot_distance"))))
    newest = F.max("created_at")
    return latest.agg(F.struct(newest.alias("newest"), threes.alias("three_point_pct"))).scalar()


def _zone_columns() -> dict[str, Column]:
    return {
        "shots": _rows(),
        "points": F.sum("expected_points"),
        "scored": F.count("expected_points"),
        "nearest": F.min("shot_distance"),
    }


def zone_sums(telemetry: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Shots, points and nearest distance by zone and grade (and ``by``): at most 15 rows
    that add up."""
    zone = S.zone(F.col("shot_distance")).alias("zone")
    return telemetry.groupBy(*by, zone, "shot_grade").agg(
        *[value.alias(name) for name, value in _zone_columns().items()]
    )


def zone_grades(telemetry: DataFrame, now: Column) -> DataFrame:
    """``zone_sums`` and the shots of the five minutes before ``now``, in one pass: what
    header, grades and zones follow from."""
    recent = F.col("created_at") >= now - F.expr("INTERVAL 5 MINUTES")
    zone = S.zone(F.col("shot_distance")).alias("zone")
    return telemetry.groupBy(zone, "shot_grade").agg(
        *[value.alias(name) for name, value in _zone_columns().items()],
        F.count_if(recent).alias("recent_shots"),
    )


def header(totals: DataFrame, threes: Column) -> DataFrame:
    """The header metrics in one row, from ``zone_grades`` and the sample's share of threes."""
    premium = F.sum(F.when(F.col("shot_grade") == "A", F.col("shots")).otherwise(0))
    total = F.coalesce(F.sum("shots"), F.lit(0))
    mean = F.try_divide(F.sum("points"), F.sum("scored"))
    return totals.agg(
        total.alias("total_shots"),
        F.coalesce(F.sum("recent_shots"), F.lit(0)).alias("recent_shots"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_xp"),
        _percent(F.try_divide(premium.cast("double"), F.sum("shots"))).alias("premium_pct"),
    ).withColumn("three_point_pct", threes)


def dashboard_snapshot(
    telemetry: DataFrame, as_of: datetime | None = None, sample: int = SAMPLE_LIMIT
) -> DataFrame:
    """The header metrics in one row: one aggregate pass, plus the sample's top-n."""
    facts = sample_facts(latest_n(telemetry, sample))
    now = facts["newest"] if as_of is None else F.lit(as_of)
    return header(zone_grades(telemetry, now), facts["three_point_pct"])
