"""Streams give what the batch gives, survive restarts and bad input."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from contract import queries as contract
from swishline.operators import analytics as A
from swishline.operators import plays as P
from swishline.operators.model import train_logistic
from swishline.operators.scoring import event_time, score_events
from swishline.plans.retrain import rated_players, split_features
from swishline.sources import artifacts, files, telemetry as store
from swishline.sources.events import (
    LATEST,
    Transport,
    publish_events,
    publish_history,
    subscribe_events,
)
from swishline.sources.scratch import scratch_dir
from swishline.streaming import live
from swishline.streaming.enrich import Scorer, skip_history, stream_enrich

ONCE = {"availableNow": True}


@pytest.fixture
def transport(spark):
    return Transport("files", scratch_dir(spark, "events"))


@pytest.fixture(scope="module")
def events(plays):
    return P.build_event(plays, F.col("created_at")).persist()


@pytest.fixture(scope="module")
def model_and_ratings(spark, plays):
    ratings = rated_players(plays)
    split = split_features(plays, ratings, F.col("play_id"))
    return train_logistic(split.where("split = 'train'")), ratings


def run(spark, transport, scorer, path, max_per_trigger=None, checkpoint=None, **options):
    query = stream_enrich(
        subscribe_events(spark, transport, max_per_trigger=max_per_trigger),
        scorer, path, f"{path}-rejects", checkpoint or f"{path}-offsets",
        created_at=event_time(), trigger=ONCE, **options)
    query.awaitTermination()
    return query


def keyed(events):
    encoded = P.encode_events(events)
    messages = encoded.select(F.md5("value").alias("shot_id"), "value")
    return P.readable(P.decode_events(messages))


def test_stream_equals_batch_without_a_model(spark, transport, events, rows):
    publish_events(events.repartition(4), transport)
    path = scratch_dir(spark, "telemetry")
    run(spark, transport, Scorer(spark, [scratch_dir(spark, "none")]), path, max_per_trigger=2)
    stored = store.read_telemetry(spark, path)
    assert rows(stored) == rows(score_events(keyed(events), None, None, event_time()))
    assert {r[0] for r in stored.select("shot_grade").distinct().collect()} == {"B", "C"}


def test_stream_equals_batch_with_a_model(spark, transport, events, model_and_ratings, rows):
    root = scratch_dir(spark, "artifacts")
    model, ratings = model_and_ratings
    artifacts.publish_ratings(ratings.frame, root)
    artifacts.publish_model(spark, model, root)
    publish_events(events.repartition(4), transport)
    path = scratch_dir(spark, "telemetry")
    scorer = Scorer(spark, [root])
    run(spark, transport, scorer, path, max_per_trigger=3)
    want = score_events(keyed(events), scorer.model, scorer.ratings, event_time())
    assert rows(store.read_telemetry(spark, path)) == rows(want)


def test_a_restart_goes_on_where_it_stopped(spark, transport, events):
    path = scratch_dir(spark, "telemetry")
    scorer = Scorer(spark, [scratch_dir(spark, "none")])
    half = F.pmod(F.xxhash64("timestamp"), F.lit(2))
    publish_events(events.where(half == 0), transport)
    run(spark, transport, scorer, path)
    first = store.read_telemetry(spark, path).count()
    run(spark, transport, scorer, path)
    assert store.read_telemetry(spark, path).count() == first
    publish_events(events.where(half == 1), transport)
    run(spark, transport, scorer, path)
    assert store.read_telemetry(spark, path).count() == events.count()


def test_a_crash_while_storing_loses_and_repeats_nothing(spark, transport, events):
    publish_events(events.repartition(4), transport)
    path = scratch_dir(spark, "telemetry")
    scorer = Scorer(spark, [scratch_dir(spark, "none")])

    def crash_after_storing(batch, target, batch_id, stream_id):
        store.append_telemetry(batch, target, batch_id, stream_id)
        if batch_id == 1:
            raise RuntimeError("lost the driver")

    with pytest.raises(Exception, match="lost the driver"):
        run(spark, transport, scorer, path, max_per_trigger=1, sink=crash_after_storing)
    run(spark, transport, scorer, path, max_per_trigger=1)
    assert store.read_telemetry(spark, path).count() == events.count()


def test_a_batch_that_runs_again_keeps_its_time_of_storage(spark, transport, events):
    publish_events(events.repartition(2), transport)
    path, times = scratch_dir(spark, "telemetry"), []

    def crash_once(batch, target, batch_id, stream_id):
        times.append(batch.agg(F.max("created_at")).first()[0])
        store.append_telemetry(batch, target, batch_id, stream_id)
        if len(times) == 1:
            raise RuntimeError("lost the driver")

    def go():
        stream_enrich(
            subscribe_events(spark, transport), Scorer(spark, []), path, f"{path}-rejects",
            f"{path}-offsets", trigger=ONCE, sink=crash_once,
        ).awaitTermination()

    with pytest.raises(Exception, match="lost the driver"):
        go()
    go()
    assert len(times) == 2 and times[0] == times[1]
    assert store.read_telemetry(spark, path).count() == events.count()


def test_streams_share_a_table_without_overwriting(spark, transport, events):
    """Two streams both begin with batch 0."""
    publish_events(events, transport)
    path = scratch_dir(spark, "telemetry")
    scorer = Scorer(spark, [scratch_dir(spark, "none")])
    for _ in range(2):
        run(spark, transport, scorer, path, checkpoint=scratch_dir(spark, "offsets"))
    assert store.read_telemetry(spark, path).count() == 2 * events.count()


def test_a_report_folder_has_one_stream(spark, transport, events):
    publish_events(events, transport)
    path = scratch_dir(spark, "minutes")
    live.stream_shots_per_minute(
        timed(spark, transport), path, f"{path}-offsets", ONCE
    ).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        live.stream_shots_per_minute(timed(spark, transport), path, f"{path}-other", ONCE)


def test_bad_messages_are_kept_apart(spark, transport, events):
    publish_events(events, transport)
    bad = spark.createDataFrame([("nonsense",), ('{"player":"x"}',)], "value string")
    bad.write.mode("append").text(transport.path)
    path = scratch_dir(spark, "telemetry")
    run(spark, transport, Scorer(spark, [scratch_dir(spark, "none")]), path)
    assert store.read_telemetry(spark, path).count() == events.count()
    rejects = spark.read.parquet(f"{path}-rejects")
    assert {r["value"] for r in rejects.collect()} == {"nonsense", '{"player":"x"}'}


def test_reload_waits_for_the_interval_and_keeps_the_old_on_failure(spark, model_and_ratings):
    root = scratch_dir(spark, "artifacts")
    model, ratings = model_and_ratings
    now = [0.0]
    scorer = Scorer(spark, [root], reload_seconds=60, clock=lambda: now[0])
    assert scorer.model is None and scorer.ratings is None

    version = artifacts.publish_model(spark, model, root)
    now[0] = 60.0
    scorer.refresh()
    assert scorer.model is None
    now[0] = 60.5
    scorer.refresh()
    assert scorer.model_version == version and scorer.ratings is None

    artifacts.publish_ratings(ratings.frame, root)
    row = spark.createDataFrame([("model", version.version + 1, "gone")], artifacts.MANIFEST)
    row.write.mode("append").parquet(f"{root}/manifest")
    now[0] = 121.0
    kept = scorer.model
    scorer.refresh()
    assert scorer.model is kept and scorer.model_version == version
    assert scorer.ratings.rows == ratings.rows


def test_skip_history_starts_at_the_latest(spark, transport, events):
    early = F.col("timestamp") < events.agg(F.avg("timestamp")).first()[0]
    publish_events(events.where(early), transport)
    path = scratch_dir(spark, "telemetry")
    offsets = scratch_dir(spark, "offsets")
    skip_history(subscribe_events(spark, transport, LATEST), offsets)
    publish_events(events.where(~early), transport)
    # a consumer that was down takes up what it missed
    skip_history(subscribe_events(spark, transport, LATEST), offsets)
    run(spark, transport, Scorer(spark, [scratch_dir(spark, "none")]), path, checkpoint=offsets)
    assert store.read_telemetry(spark, path).count() == events.where(~early).count()


def timed(spark, transport, **options):
    messages = subscribe_events(spark, transport, **options)
    return P.readable(P.decode_events(messages)).withColumn("event_time", event_time())


def test_minutes_equal_the_batch(spark, transport, events, rows):
    publish_events(events.repartition(3), transport)
    path = scratch_dir(spark, "minutes")
    live.stream_shots_per_minute(
        timed(spark, transport, max_per_trigger=1), path, f"{path}-offsets", ONCE, "3650 days"
    ).awaitTermination()
    minute = F.date_trunc("minute", event_time()).alias("minute")
    want = keyed(events).groupBy(minute).agg(F.count(F.lit(1)).alias("shots"))
    assert rows(live.shots_per_minute_now(spark, path)) == rows(want)


def test_minutes_drop_what_is_too_late(spark, transport, events):
    one = events.limit(1).persist()
    noon = datetime(2024, 1, 1, 12)
    path = scratch_dir(spark, "minutes")

    def send(*times):
        """Late events, and the minutes that the state says it has changed."""
        at = F.explode(F.array(*map(F.lit, times)))
        sent = one.withColumn("at", at).withColumn("timestamp", F.unix_micros("at") / 1e6)
        publish_events(sent.drop("at"), transport)
        query = live.stream_shots_per_minute(
            timed(spark, transport), path, f"{path}-offsets", ONCE
        )
        query.awaitTermination()
        states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
        return live.late_rows(query, path), sum(s["numRowsUpdated"] for s in states)

    send(noon)
    send(noon + timedelta(minutes=30))
    late, updated = send(noon - timedelta(minutes=5))
    assert (late, updated) == (1, 0)
    assert send(noon + timedelta(minutes=25)) == (0, 1)
    # two events of one late minute, and one that is in time
    assert send(*[noon - timedelta(minutes=3)] * 2, noon + timedelta(minutes=25)) == (2, 1)
    counts = [r["shots"] for r in live.shots_per_minute_now(spark, path).orderBy("minute").collect()]
    assert counts == [1, 2, 1]


def test_a_batch_of_minutes_that_runs_again_counts_the_same(spark, transport, events, monkeypatch):
    """The driver is lost after a batch's minutes are merged, before the batch is done."""
    publish_events(events, transport)
    path, merges = scratch_dir(spark, "minutes"), []
    plain = live._start

    def go():
        query = live.stream_shots_per_minute(
            timed(spark, transport), path, f"{path}-offsets", ONCE, "3650 days"
        )
        query.awaitTermination()
        return query

    def lost_once(result, mode, store, *more):
        def crash(batch, batch_id):
            store(batch, batch_id)
            merges.append(batch_id)
            if len(merges) == 1:
                raise RuntimeError("lost the driver")

        return plain(result, mode, crash, *more)

    monkeypatch.setattr(live, "_start", lost_once)
    with pytest.raises(Exception, match="lost the driver"):
        go()
    assert live.late_rows(go(), path) == 0
    assert live.shots_per_minute_now(spark, path).agg(F.sum("shots")).first()[0] == events.count()


def test_history_is_replayed_in_order(spark, transport, events, rows):
    """A file per batch, in order of time: nothing is late at the default watermark."""
    names = publish_history(events.repartition(5), transport, 6)
    again = publish_history(events.withColumn("timestamp", F.col("timestamp") + 1e9), transport, 2)
    assert len(names) == 6 and len(again) == 2
    base, spans = scratch_dir(spark, "replay"), []

    def note(batch, batch_id):
        spans.append(tuple(batch.agg(F.min("event_time"), F.max("event_time")).first()))

    source = timed(spark, transport, max_per_trigger=1)
    source.writeStream.foreachBatch(note).trigger(**ONCE).option(
        "checkpointLocation", f"{base}/a").start().awaitTermination()
    assert len(spans) == 8
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    minutes = live.stream_shots_per_minute(source, f"{base}/minutes", f"{base}/b", ONCE)
    minutes.awaitTermination()
    assert live.late_rows(minutes, f"{base}/minutes") == 0
    total = live.shots_per_minute_now(spark, f"{base}/minutes").agg(F.sum("shots")).first()[0]
    assert total == 2 * events.count()
    with pytest.raises(ValueError, match="files only"):
        publish_history(events, Transport("kafka", "nowhere:1"), 2)


def test_live_totals_take_up_a_new_model(spark, transport, events, model_and_ratings):
    """The second batch meets a model that is published after the first."""
    root, path = scratch_dir(spark, "artifacts"), scratch_dir(spark, "totals")
    model, ratings = model_and_ratings
    scorer = Scorer(spark, [root], reload_seconds=-1)
    half = F.pmod(F.xxhash64("timestamp"), F.lit(2))
    plain = scorer.score

    def publish_then_score(batch, created_at=None):
        scored = plain(batch, created_at)
        if scorer.model is None:
            artifacts.publish_ratings(ratings.frame, root)
            artifacts.publish_model(spark, model, root)
        return scored

    scorer.score = publish_then_score
    publish_events(events.where(half == 0).coalesce(1), transport)
    publish_events(events.where(half == 1).coalesce(1), transport)
    query = live.stream_live_totals(
        timed(spark, transport, max_per_trigger=1), scorer, path, f"{path}-offsets", ONCE
    )
    query.awaitTermination()
    parts = [keyed(events.where(half == 0)), keyed(events.where(half == 1))]
    expected = score_events(parts[0], None, None).unionByName(
        score_events(parts[1], scorer.model, scorer.ratings)
    )
    now = live.running_totals_now(spark, path)
    head = live.headline(now).first()
    assert head["total_shots"] == events.count()
    assert head["avg_xp"] == pytest.approx(A.avg_xp(expected).first()[0])
    got = {r["grade"]: r["shots"] for r in live.grades(now).collect()}
    assert got == {r["grade"]: r["shots"] for r in A.grade_distribution(expected).collect()}


def test_running_totals_equal_the_reports(spark, transport, events, rows):
    publish_events(events.repartition(3), transport)
    path = scratch_dir(spark, "totals")
    scored = score_events(timed(spark, transport, max_per_trigger=1), None, None, event_time())
    live.stream_running_totals(scored, path, f"{path}-offsets", ONCE).awaitTermination()
    now = live.running_totals_now(spark, path)
    batch = score_events(keyed(events), None, None, event_time())
    assert now.count() <= 15
    head = live.headline(now).first()
    assert head["total_shots"] == A.total_shots(batch).first()[0]
    assert head["avg_xp"] == pytest.approx(A.avg_xp(batch).first()[0])
    assert rows(live.grades(now)) == rows(A.grade_distribution(batch))
    for got, want in zip(live.zones(now).collect(), A.zone_stats(batch).collect(), strict=True):
        assert got["zone"] == want["zone"] and got["shots"] == want["shots"]
        assert got["avg_xp"] == pytest.approx(want["avg_xp"])


def test_unknown_transport_is_refused():
    with pytest.raises(ValueError):
        Transport("carrier pigeon", "roof")


def test_equal_events_keep_keys_of_their_own(spark, transport, events):
    two = events.limit(1).unionAll(events.limit(1))
    publish_events(two.withColumn(P.EVENT_KEY, F.uuid()), transport)
    path = scratch_dir(spark, "telemetry")
    run(spark, transport, Scorer(spark, []), path)
    assert store.read_telemetry(spark, path).select("shot_id").distinct().count() == 2


def test_live_results_stay_bounded(spark, transport, events, rows):
    """Many micro-batches leave few folders, and the reports of the batch."""
    publish_events(events.repartition(12), transport)
    base = scratch_dir(spark, "live")
    source = timed(spark, transport, max_per_trigger=1)
    minutes = live.stream_shots_per_minute(
        source, f"{base}/minutes", f"{base}/a", ONCE, "3650 days"
    )
    minutes.awaitTermination()
    assert live.late_rows(minutes, f"{base}/minutes") == 0
    scored = score_events(source, None, None, event_time())
    live.stream_running_totals(scored, f"{base}/totals", f"{base}/b", ONCE).awaitTermination()
    assert len(files.values(spark, f"{base}/totals", "batch_id")) <= live.KEPT_STATES
    days = events.select(F.to_date(event_time())).distinct().count()
    assert len(files.values(spark, f"{base}/minutes", "day")) == days
    total = live.headline(live.running_totals_now(spark, f"{base}/totals")).first()["total_shots"]
    counted = live.shots_per_minute_now(spark, f"{base}/minutes")
    assert total == events.count() == counted.agg(F.sum("shots")).first()[0]
    assert counted.count() == counted.select("minute").distinct().count()


def test_equal_messages_are_compared_without_making_their_pairs(spark):
    def scores(count, *others):
        one = "1.5D AS expected_points, 'A' AS shot_grade"
        shot = "'same' AS shot_id, timestamp '2024-01-01' AS event_time, 7 AS shot_distance"
        rows = spark.range(count).selectExpr(*[p.strip() for p in f"{shot}, {one}".split(",")])
        for shot_id, at, points in others:
            other = spark.sql(f"SELECT '{shot_id}', timestamp '{at}', 7, {points}, 'A'")
            rows = rows.unionByName(other.toDF(*rows.columns))
        return rows

    many = 200_000  # 40 billion pairs
    stored = scores(many, ("a", "2024-01-02", "1D"), ("b", "2024-01-03", "1D"))
    batch = scores(many, ("a", "2024-01-02", "1D"), ("b", "2024-01-03", "2D"))
    found = {r["event_time"].day: r for r in contract.as_batch(stored, batch).collect()}
    assert {day: r["shots"] for day, r in found.items()} == {1: many**2, 2: 1, 3: 1}
    assert {day: r["as_batch"] for day, r in found.items()} == {1: True, 2: True, 3: False}
    # one of the equal ones differs from the others, on both sides
    odd = scores(3, ("same", "2024-01-01", "2D"))
    assert contract.as_batch(odd, odd).collect()[0]["as_batch"] is False
