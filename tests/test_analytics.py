from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from swishline.operators import analytics as A
from swishline.operators.sampling import latest_n, recent_shots, sample_n, train_test_split
from swishline.plans.dashboard import refresh
from swishline.schemas import TELEMETRY

NOON = datetime(2024, 1, 1, 12)


def one(df):
    return df.first()[0]


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], TELEMETRY)


def test_empty_table(empty):
    assert one(A.total_shots(empty)) == 0
    assert one(A.avg_xp(empty)) == 0.0
    assert one(A.premium_pct(empty)) == 0.0
    assert one(A.three_point_pct(empty)) == 0.0
    assert [tuple(r)[0::2] for r in A.grade_distribution(empty).collect()] == [
        ("A", 0), ("B", 0), ("C", 0)]
    assert [r["percent"] for r in A.grade_distribution(empty).collect()] == [0.0] * 3
    assert A.zone_stats(empty).count() == 0
    assert A.shots_per_minute(empty).count() == 0
    assert A.distance_histogram(empty).count() == 0
    assert tuple(A.dashboard_snapshot(empty).first()) == (0, 0, 0.0, 0.0, 0.0)


def test_grades_and_zones_partition_the_shots(telemetry):
    total = one(A.total_shots(telemetry))
    grades = A.grade_distribution(telemetry).collect()
    assert sum(r["shots"] for r in grades) == total
    assert sum(r["percent"] for r in grades) == pytest.approx(100)
    assert sum(r["shots"] for r in A.zone_stats(telemetry).collect()) == total


def test_points_have_bounds(telemetry):
    assert telemetry.where("expected_points < 0 OR expected_points > 3").count() == 0
    assert telemetry.where("expected_points > 2 AND shot_distance <= 23").count() == 0


def test_zones_are_in_order_of_distance(telemetry):
    names = [r["zone"] for r in A.zone_stats(telemetry).collect()]
    assert [n.split(" ")[0] for n in names] == ["Rim", "Paint", "Mid-Range", "Long", "3-Pointer"]


def shots_at(spark, *times):
    rows = [(str(i), "g", "p", 5, 1.0, "B", t, t) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, TELEMETRY)


def test_time_windows_are_inclusive_and_absent_minutes_stay_absent(spark, rows):
    shots = shots_at(spark, NOON, NOON - timedelta(minutes=5), NOON - timedelta(minutes=5, seconds=1),
                     NOON - timedelta(minutes=60), NOON - timedelta(minutes=61))
    assert one(A.recent_activity(shots)) == 2
    assert one(A.recent_activity(shots, NOON + timedelta(minutes=1))) == 1
    per_minute = rows(A.shots_per_minute(shots))
    assert [n for _, n in per_minute] == [1, 1, 1, 1]
    assert len(rows(A.shots_per_minute(shots, NOON))) == 4


def test_leaderboard_breaks_ties_by_name(spark):
    rows = [(str(i), "g", f"p{i % 12:02d}", 5, 1.0, "B", NOON, NOON) for i in range(24)]
    board = A.player_leaderboard(spark.createDataFrame(rows, TELEMETRY)).collect()
    assert [r["player_name"] for r in board] == [f"p{i:02d}" for i in range(10)]


def test_histogram_counts_every_row_once(telemetry):
    bins = A.distance_histogram(telemetry).collect()
    assert len(bins) <= 25
    assert sum(r["shots"] for r in bins) == telemetry.count()
    counts = dict(telemetry.groupBy("shot_distance").count().collect())
    for r in bins:
        inside = range(r["bin_start"], r["bin_start"] + r["bin_width"])
        assert r["shots"] == sum(counts.get(d, 0) for d in inside)


def test_snapshot_agrees_with_the_single_reports(telemetry):
    snap = A.dashboard_snapshot(telemetry).first()
    assert snap["total_shots"] == one(A.total_shots(telemetry))
    assert snap["recent_shots"] == one(A.recent_activity(telemetry))
    assert snap["avg_xp"] == pytest.approx(one(A.avg_xp(telemetry)))
    assert snap["premium_pct"] == pytest.approx(one(A.premium_pct(telemetry)))
    assert snap["three_point_pct"] == pytest.approx(one(A.three_point_pct(telemetry)))


def test_latest_n(telemetry):
    newest = [r["created_at"] for r in latest_n(telemetry, 100).collect()]
    every = sorted((r["created_at"] for r in telemetry.select("created_at").collect()), reverse=True)
    assert newest == every[:100]
    for n in (99, 5001):
        with pytest.raises(ValueError):
            latest_n(telemetry, n)


def test_samples_do_not_depend_on_partitioning(telemetry, rows):
    a = rows(sample_n(telemetry))
    assert len(a) == 200 == len({r[0] for r in a})
    assert a == rows(sample_n(telemetry.repartition(13)))
    few = telemetry.limit(50)
    assert sample_n(few).count() == 50


def test_recent_shots_names(telemetry):
    top = recent_shots(telemetry)
    assert top.columns == ["Player", "Distance (ft)", "Expected Points", "Grade", "Time"]
    assert top.count() == 20


def test_positions_keep_their_distance(telemetry):
    moved = A.shot_position(telemetry).select(
        "shot_distance", F.hypot(F.col("x"), F.col("y") + 250).alias("r"), "y"
    )
    assert moved.where(F.abs(F.col("r") - F.col("shot_distance") * 10) > 1e-6).count() == 0
    assert moved.where("y < -250.000001").count() == 0


def test_split_is_stable_and_fair(plays, rows):
    split = train_test_split(plays, F.col("play_id")).select("play_id", "split")
    again = train_test_split(plays.repartition(7), F.col("play_id")).select("play_id", "split")
    assert rows(split) == rows(again)
    share = split.where("split = 'test'").count() / split.count()
    assert 0.15 < share < 0.25


def test_refresh_gives_every_report(telemetry):
    reports = refresh(telemetry)
    assert {n: r.count() > 0 for n, r in reports.items()} == dict.fromkeys(reports, True)
    assert reports["shot_map"].count() == 200


def test_plans_have_no_full_sort_and_no_python(spark, telemetry):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    text = latest_n(telemetry)._jdf.queryExecution().explainString(mode)
    assert "TakeOrderedAndProject" in text
    for report in (A.zone_stats, A.dashboard_snapshot, A.distance_histogram, A.shot_position):
        text = report(telemetry)._jdf.queryExecution().explainString(mode)
        assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_a_refresh_scans_the_table_twice(spark, telemetry):
    """Header, grades and zones share one pass; the leaderboard is the other."""
    from swishline.plans.dashboard import refresh_stored
    from swishline.sources.scratch import scratch_dir
    from swishline.sources.telemetry import append_telemetry

    path = scratch_dir(spark, "telemetry")
    append_telemetry(telemetry, path, 0)
    as_of = telemetry.agg(F.max("created_at")).first()[0]
    reports = refresh_stored(spark, path, as_of)
    whole = 0
    for name in ("header", "grades", "zones", "players"):
        plan = reports[name]._jdf.queryExecution().optimizedPlan().toString()
        whole += name == "players" or "InMemoryRelation" not in plan
    assert whole == 1
    snap = A.dashboard_snapshot(telemetry, as_of).first()
    assert reports["header"].first()["total_shots"] == snap["total_shots"] == telemetry.count()


def test_unknown_distances_come_last(spark, telemetry):
    far = telemetry.limit(1).withColumn("shot_distance", F.lit(None).cast("int"))
    zones = [r["zone"] for r in A.zone_stats(telemetry.where("shot_distance <= 3").unionByName(far)).collect()]
    assert zones[0].startswith("Rim") and len(zones) == 2
