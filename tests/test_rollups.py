"""Reports over roll-ups equal those over the shots, and open the shots of open days only."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from contract import bindings
from swishline.operators import analytics as A
from swishline.plans.dashboard import refresh, refresh_stored
from swishline.sources import rollups
from swishline.sources import telemetry as store
from swishline.sources.scratch import scratch_dir

PART = "pmod(xxhash64(shot_id), 4)"


@pytest.fixture(scope="module")
def telemetry(spark):
    """The last three days."""
    rows = bindings.telemetry(spark, SMALL)
    last = rows.agg(F.max("created_at")).first()[0]
    return rows.where(F.col("created_at") >= F.lit(last - timedelta(days=2))).persist()


@pytest.fixture
def path(spark, telemetry):
    """Four batches, compacted up to the last day but one."""
    place = scratch_dir(spark, "telemetry")
    for batch in range(4):
        store.append_telemetry(telemetry.where(f"{PART} = {batch}"), place, batch, "s")
    store.compact(spark, place, store.stored_days(spark, place)[-1])
    return place


def told(report):
    """Rows with doubles to 9 places: sums over parts add up in another order."""
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in report.collect()),
        key=str,
    )


def same_reports(spark, path, rows):
    as_of = rows.agg(F.max("created_at")).first()[0]
    found, want = refresh_stored(spark, path, as_of), refresh(rows, as_of)
    assert found.keys() == want.keys()
    for name in want:
        assert told(found[name]) == told(want[name]), name
    return found


def days_opened(report):
    """Days whose shots a report reads, and whether it reads roll-ups."""
    files = report.inputFiles()
    shots = [f for f in files if "created_date=" in f and "_rollup/" not in f]
    return {f.split("created_date=")[1][:10] for f in shots}, any("_rollup/" in f for f in files)


def test_a_refresh_opens_the_shots_of_open_days_only(spark, telemetry, path):
    days = store.stored_days(spark, path)
    split = store.split_days(spark, path)
    assert split.open_days == days[-1:]
    assert {day for day, _ in split.rolled} == set(days[:-1])
    found = same_reports(spark, path, telemetry)
    assert days_opened(found["players"]) == ({str(days[-1])}, True)
    sums = store.zone_sums_of_all_time(spark, path, split)
    assert days_opened(sums) == ({str(days[-1])}, True)
    assert found["header"].first()["total_shots"] == telemetry.count()


def test_a_late_batch_opens_its_day_until_the_next_compaction(spark, telemetry, path):
    days = store.stored_days(spark, path)
    first = F.to_date("created_at") == F.lit(days[0])
    extra = telemetry.where(first).limit(3)
    store.append_telemetry(extra, path, 4, "s")
    rows = telemetry.unionByName(extra)
    assert store.split_days(spark, path).open_days == [days[0], days[-1]]
    same_reports(spark, path, rows)
    assert store.compact(spark, path, days[-1]) == 1
    split = store.split_days(spark, path)
    assert split.open_days == days[-1:]
    assert len([1 for day, _ in split.rolled if day == days[0]]) == 2
    same_reports(spark, path, rows)


def test_a_batch_that_runs_again_after_compaction_changes_nothing(spark, telemetry, path):
    store.append_telemetry(telemetry.where(f"{PART} = 3"), path, 3, "s")
    assert len(store.split_days(spark, path).open_days) == 1
    same_reports(spark, path, telemetry)


def test_what_was_compacted_without_roll_ups_is_read_until_it_has_them(
    spark, telemetry, monkeypatch
):
    place = scratch_dir(spark, "telemetry")
    store.append_telemetry(telemetry, place, 0, "s")
    days = store.stored_days(spark, place)
    with monkeypatch.context() as patch:
        patch.setattr(store, "roll_up", lambda spark, path: 0)  # the driver is lost in between
        store.compact(spark, place, days[-1])
    assert store.split_days(spark, place).open_days == days
    assert rollups.stored(spark, place) == set()
    same_reports(spark, place, telemetry)
    assert store.compact(spark, place, days[-1]) == 0
    assert store.split_days(spark, place).open_days == days[-1:]
    same_reports(spark, place, telemetry)


def test_every_day_may_be_closed(spark, telemetry, path):
    last = store.stored_days(spark, path)[-1]
    store.compact(spark, path, last + timedelta(days=1))
    split = store.split_days(spark, path)
    assert split.open_days == []
    found = same_reports(spark, path, telemetry)
    assert days_opened(found["players"]) == (set(), True)


def test_unknown_values_roll_up(spark, telemetry):
    """Shots without a distance, a player or points."""
    odd = telemetry.limit(40).withColumns(
        {
            "shot_distance": F.when(F.col("shot_distance") > 9, F.col("shot_distance")),
            "player_name": F.when(F.col("shot_grade") != "A", F.col("player_name")),
            "expected_points": F.when(F.col("shot_distance") < 20, F.col("expected_points")),
        }
    )
    place = scratch_dir(spark, "telemetry")
    store.append_telemetry(odd, place, 0, "s")
    store.compact(spark, place, store.stored_days(spark, place)[-1] + timedelta(days=1))
    split = store.split_days(spark, place)
    assert split.open_days == []
    assert told(store.zone_sums_of_all_time(spark, place, split)) == told(A.zone_sums(odd))
    players = A.busiest(store.player_sums_of_all_time(spark, place, split))
    assert told(players) == told(A.player_leaderboard(odd))


def test_a_database_is_read_by_ranges_of_its_key():
    assert store.key_ranges(None, None, 10) == {}
    assert store.key_ranges(1, 10, 10) == {}
    assert store.key_ranges(5, 104, 10) == {
        "partitionColumn": "id", "lowerBound": "5", "upperBound": "105", "numPartitions": "10",
    }
    assert store.key_ends_query("t") == "(SELECT MIN(id) AS least, MAX(id) AS most FROM t) AS ends"
