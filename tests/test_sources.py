from __future__ import annotations

import os
import shutil
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from swishline.operators.sampling import latest_n
from swishline.operators.skill import player_skill, player_totals
from swishline.sources import artifacts, telemetry as store
from swishline.sources.plays import scan_plays, write_plays
from swishline.sources.scratch import scratch_dir
from swishline.schemas import PLAYS, TELEMETRY_COLUMNS


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "EXTRA,player1_name,Period,EVENTMSGTYPE,game_id,"
        "homedescription,visitordescription,pctimestring\n"
        "x,\"Foo, Jr.\",1.0,2,0022300001,,MISS Foo 26' 3PT,11:38\n"
        "y,\"\",,1,0022300002,Bar 2' Layup,,\n"
    )
    got = [tuple(r) for r in scan_plays(spark, str(tmp_path), extra=("extra",)).collect()]
    assert sorted(got) == [
        ("x", "0022300001", 2, 1, "11:38", None, "MISS Foo 26' 3PT", "Foo, Jr."),
        ("y", "0022300002", 1, None, None, "Bar 2' Layup", None, ""),
    ]


def test_csv_without_a_needed_column_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("game_id,period\n1,2\n")
    with pytest.raises(ValueError, match="eventmsgtype"):
        scan_plays(spark, str(tmp_path))


def test_csv_round_trip(spark, plays, rows):
    path = scratch_dir(spark, "csv")
    columns = PLAYS.fieldNames()
    write_plays(plays.select(*columns), path)
    assert rows(scan_plays(spark, path)) == rows(plays.select(*columns))


def test_csv_scan_is_pruned(spark, plays):
    path = scratch_dir(spark, "csv")
    write_plays(plays.select(*PLAYS.fieldNames()), path)
    totals = player_totals(scan_plays(spark, path))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    plan = totals._jdf.queryExecution().explainString(mode)
    assert "ReadSchema: struct<eventmsgtype:string,player1_name:string>" in plan


def test_a_batch_that_runs_again_replaces_itself(spark, telemetry, rows):
    path = scratch_dir(spark, "telemetry")
    near, far = telemetry.where("shot_distance <= 10"), telemetry.where("shot_distance > 10")
    store.append_telemetry(near, path, 0)
    store.append_telemetry(far.limit(5), path, 1)
    store.append_telemetry(far, path, 1)
    back = store.read_telemetry(spark, path)
    assert rows(back) == rows(telemetry)
    assert store.scan_telemetry(back).columns == TELEMETRY_COLUMNS


def test_time_bounded_reads_skip_days(spark, telemetry):
    path = scratch_dir(spark, "telemetry")
    store.append_telemetry(telemetry, path, 0)
    since = datetime(2024, 1, 25, 12)
    recent = store.read_telemetry(spark, path, since)
    assert recent.count() == telemetry.where(F.col("created_at") >= F.lit(since)).count()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    plan = recent._jdf.queryExecution().explainString(mode)
    assert "GreaterThanOrEqual(created_at" in plan
    assert len(recent.inputFiles()) < len(store.read_telemetry(spark, path).inputFiles())


def test_newest_days_hold_the_newest_rows(spark, telemetry, rows):
    path = scratch_dir(spark, "telemetry")
    store.append_telemetry(telemetry, path, 0)
    everything = store.read_telemetry(spark, path)
    for n in (100, 300, 5000):
        days = store.read_newest_days(spark, path, n)
        assert rows(latest_n(days, n)) == rows(latest_n(everything, n))
    assert store.read_newest_days(spark, path, 100).count() < telemetry.count()


def test_a_batch_leaves_one_file_per_small_day(spark, telemetry):
    path = scratch_dir(spark, "telemetry")
    store.append_telemetry(telemetry.repartition(8), path, 0)
    days = telemetry.select(F.to_date("created_at")).distinct().count()
    assert len(store.read_telemetry(spark, path).inputFiles()) == days


def test_artifacts_fall_back_in_order(spark, plays):
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "b")
    assert artifacts.load_ratings(spark, [first, second]) is None
    ratings = player_skill(player_totals(plays))
    artifacts.publish_ratings(ratings.limit(3), second)
    assert artifacts.load_ratings(spark, [first, second])[1].rows == 3
    artifacts.publish_ratings(ratings.limit(2), first)
    assert artifacts.load_ratings(spark, [first, second])[1].rows == 2


def test_newest_version_wins_and_is_taken_once(spark, plays):
    root = scratch_dir(spark, "a")
    ratings = player_skill(player_totals(plays))
    artifacts.publish_ratings(ratings.limit(3), root)
    newest = artifacts.publish_ratings(ratings.limit(4), root)
    version, table = artifacts.load_ratings(spark, [root])
    assert version == newest and table.rows == 4
    assert artifacts.load_ratings(spark, [root], version) is None


def test_empty_ratings_do_not_count(spark, plays):
    root = scratch_dir(spark, "a")
    artifacts.publish_ratings(player_skill(player_totals(plays)).limit(0), root)
    assert artifacts.load_ratings(spark, [root]) is None


def test_a_listed_but_missing_artifact_falls_through(spark, plays):
    broken, good = scratch_dir(spark, "a"), scratch_dir(spark, "b")
    row = spark.createDataFrame([("player_ratings", 9, "gone")], artifacts.MANIFEST)
    row.write.parquet(f"{broken}/manifest")
    artifacts.publish_ratings(player_skill(player_totals(plays)).limit(3), good)
    assert artifacts.load_ratings(spark, [broken, good])[1].rows == 3


def test_a_broken_version_gives_way_to_the_one_before(spark, plays):
    root = scratch_dir(spark, "a")
    good = artifacts.publish_ratings(player_skill(player_totals(plays)).limit(3), root)
    row = spark.createDataFrame([("player_ratings", good.version + 1, "gone")], artifacts.MANIFEST)
    row.write.mode("append").parquet(f"{root}/manifest")
    version, table = artifacts.load_ratings(spark, [root])
    assert version == good and table.rows == 3
    assert artifacts.load_ratings(spark, [root], good) is None


def test_a_first_root_that_appears_late_comes_first(spark, plays):
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "b")
    ratings = player_skill(player_totals(plays))
    older = artifacts.publish_ratings(ratings.limit(2), f"{first}-elsewhere")
    newer = artifacts.publish_ratings(ratings.limit(3), second)
    assert artifacts.load_ratings(spark, [first, second])[0] == newer
    shutil.copytree(f"{first}-elsewhere", first)
    version, table = artifacts.load_ratings(spark, [first, second], newer)
    assert (version.version, version.root, table.rows) == (older.version, first, 2)


def test_a_copied_root_stands_alone(spark, plays):
    root = scratch_dir(spark, "a")
    artifacts.publish_ratings(player_skill(player_totals(plays)).limit(3), root)
    shutil.copytree(root, f"{root}-copy")
    os.rename(root, f"{root}-gone")
    assert artifacts.load_ratings(spark, [f"{root}-copy"])[1].rows == 3


def stored_files(root):
    return sum(len(names) for _, _, names in os.walk(root))


def test_a_hundred_publications_leave_few_files(spark, plays):
    root = scratch_dir(spark, "a")
    ratings = player_skill(player_totals(plays)).limit(3).persist()
    first = artifacts.publish_ratings(ratings, root)
    rows = []
    for i in range(1, 100):  # a publication is a folder and a file of the manifest
        shutil.copytree(first.location, f"{root}/player_ratings/{first.version + i}")
        rows.append(("player_ratings", first.version + i, f"player_ratings/{first.version + i}"))
    for part in range(99):
        frame = spark.createDataFrame(rows[part : part + 1], artifacts.MANIFEST)
        if part % 33 == 0:
            frame = spark.createDataFrame(rows[part : part + 33], artifacts.MANIFEST)
            frame.repartition(33).write.mode("append").parquet(f"{root}/manifest")
    before = stored_files(root)
    assert artifacts.expire(spark, root) == 0  # all of them are young
    assert artifacts.expire(spark, root, grace_seconds=-60) == 97
    assert stored_files(root) < 30 < before
    version, table = artifacts.load_ratings(spark, [root])
    assert version.version == first.version + 99 and table.rows == 3
    assert len(artifacts.newest_versions(spark, root, "player_ratings")) == 3
    assert artifacts.expire(spark, root, grace_seconds=-60) == 0


def test_the_version_in_use_outlives_broken_newer_ones(spark, plays):
    root = scratch_dir(spark, "a")
    ratings = player_skill(player_totals(plays))
    old = artifacts.publish_ratings(ratings.limit(2), root)
    used = artifacts.publish_ratings(ratings.limit(3), root)
    rows = [("player_ratings", used.version + i, f"player_ratings/{used.version + i}") for i in (1, 2, 3)]
    spark.createDataFrame(rows, artifacts.MANIFEST).write.mode("append").parquet(f"{root}/manifest")
    assert artifacts.expire(spark, root, keep=1, grace_seconds=-60) == 1
    version, table = artifacts.load_ratings(spark, [root])
    assert version == used and table.rows == 3
    assert not os.path.exists(old.location)


def test_a_version_that_was_just_replaced_stays(spark, plays):
    root = scratch_dir(spark, "a")
    ratings = player_skill(player_totals(plays))
    versions = [artifacts.publish_ratings(ratings.limit(n), root) for n in (1, 2, 3)]
    # the oldest has been replaced long ago by these clocks, the middle one just now
    grace = (versions[2].version - versions[1].version) / 2e6
    now = versions[2].version / 1e6
    artifacts.expire(spark, root, keep=1, grace_seconds=time.time() - now + grace)
    assert [os.path.exists(v.location) for v in versions] == [False, True, True]
    assert artifacts.expire(spark, scratch_dir(spark, "none")) == 0


def test_csv_follows_the_usual_quoting(spark, tmp_path):
    header = "game_id,eventmsgtype,period,pctimestring,homedescription,visitordescription,player1_name"
    awkward = 'O""Neal 5\' Layup, ""alley"" oop'
    lines = [
        f'1,1,2,11:38,"{awkward}",away,Foo',
        '2,1,2,11:38,"ends in a backslash\\",away,Foo',
        '3,1,2,11:38,plain \\ text,"",Foo',
        '4,1,2,11:38,"two\nlines",away,Foo',
    ]
    (tmp_path / "a.csv").write_text("\n".join([header, *lines, ""]))
    read = scan_plays(spark, str(tmp_path), multi_line=True)
    got = [(r["game_id"], r["homedescription"], r["visitordescription"]) for r in read.collect()]
    assert sorted(got) == [
        ("1", awkward.replace('""', '"'), "away"),
        ("2", "ends in a backslash\\", "away"),
        ("3", "plain \\ text", ""),
        ("4", "two\nlines", "away"),
    ]
    path = scratch_dir(spark, "csv")
    write_plays(read, path)
    back = scan_plays(spark, path, multi_line=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, read.collect()))


def test_compaction_changes_no_row_and_removes_files_later(spark, telemetry, rows):
    path = scratch_dir(spark, "telemetry")
    telemetry = telemetry.where("created_at >= '2024-01-26'").persist()
    part = F.pmod(F.xxhash64("shot_id"), F.lit(4))
    for batch in range(4):
        store.append_telemetry(telemetry.where(part == batch), path, batch, "s")
    days = store.stored_days(spark, path)
    before = len(store._stored(spark, path).inputFiles())
    assert store.compact(spark, path, days[-1]) == len(days) - 1
    assert rows(store.read_telemetry(spark, path)) == rows(telemetry)
    # the batch before the last runs again after compaction
    store.append_telemetry(telemetry.where(part == 3), path, 3, "s")
    assert rows(store.read_telemetry(spark, path)) == rows(telemetry)
    # a later batch of a compacted day counts
    extra = telemetry.limit(1)
    store.append_telemetry(extra, path, 4, "s")
    assert store.read_telemetry(spark, path).count() == telemetry.count() + 1
    assert store.compact(spark, path, days[-1]) <= 1
    assert store.read_telemetry(spark, path).count() == telemetry.count() + 1
    assert store.compact(spark, path, days[-1]) == 0
    assert len(store._stored(spark, path).inputFiles()) < before / 2
    assert rows(latest_n(store.read_newest_days(spark, path, 100), 100)) == rows(
        latest_n(store.read_telemetry(spark, path), 100)
    )


def test_a_read_of_one_day_lists_that_day(spark, telemetry):
    path = scratch_dir(spark, "telemetry")
    store.append_telemetry(telemetry, path, 0)
    last = store.stored_days(spark, path)[-1]
    recent = store.read_telemetry(spark, path, datetime(last.year, last.month, last.day, 12))
    listed = {f.split("created_date=")[1][:10] for f in recent.inputFiles()}
    assert str(last) in listed and len(listed) <= 2
