"""Messages that cannot be read are kept, gathered, and count once when they are mended."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from swishline.operators import plays as P
from swishline.operators.scoring import score_events
from swishline.plans import rejects as job
from swishline.sources import files, rejects
from swishline.sources import telemetry as store
from swishline.sources.events import Transport, publish_events, subscribe_events
from swishline.sources.scratch import scratch_dir
from swishline.streaming.enrich import Scorer, stream_enrich


def mend(value):
    """Senders that put a mark before the text."""
    return F.regexp_replace(value, "^#+", "")


def score(events, created_at):
    return score_events(events, None, None, created_at)


@pytest.fixture(scope="module")
def events(plays):
    return P.build_event(plays, F.col("created_at")).limit(40).persist()


@pytest.fixture
def places(spark, events):
    """A stream that met 12 marked messages in three batches, and one that none can read."""
    transport, path = Transport("files", scratch_dir(spark, "events")), scratch_dir(spark, "telemetry")
    publish_events(events.limit(20).coalesce(1), transport)
    marked = P.encode_events(events.limit(12)).select(F.concat(F.lit("##"), "value").alias("value"))
    marked.repartition(2).write.mode("append").text(transport.path)
    spark.createDataFrame([("nonsense",)], "value string").coalesce(1).write.mode("append").text(
        transport.path
    )
    query = stream_enrich(
        subscribe_events(spark, transport, max_per_trigger=1), Scorer(spark, []), path,
        f"{path}_rejects", f"{path}-offsets", trigger={"availableNow": True},
    )
    query.awaitTermination()
    return path, f"{path}_rejects"


def texts(spark, path):
    return sorted(r["value"] for r in rejects.read_rejects(spark, path).collect())


def test_compaction_keeps_every_reject_in_few_files(spark, places):
    _, path = places
    before = texts(spark, path)
    assert len(before) == 13
    assert rejects.compact_rejects(spark, path) == 13
    assert texts(spark, path) == before
    assert rejects.compact_rejects(spark, path) == 13
    assert texts(spark, path) == before
    streams = [s for s in files.values(spark, path, "stream_id") if s != rejects.LEFT]
    left = [files.values(spark, f"{path}/stream_id={s}", "batch_id") for s in streams]
    assert left == [[]]  # the batches that were gathered are gone
    # a later batch counts beside what was gathered
    more = spark.createDataFrame([("k", "late nonsense")], "shot_id string, value string")
    more.write.parquet(f"{path}/stream_id={streams[0]}/batch_id=99")
    assert texts(spark, path) == sorted([*before, "late nonsense"])


def test_a_mended_reject_counts_once(spark, places):
    table, path = places
    for _ in range(2):
        assert rejects.replay_rejects(spark, path, mend, score, table) == 1
        assert store.read_telemetry(spark, table).count() == 32
        assert texts(spark, path) == ["nonsense"]


def test_a_replay_that_is_lost_half_way_is_done_again(spark, places, monkeypatch):
    """Telemetry is stored, the driver is lost, and the mend is changed before the next try."""
    table, path = places
    plain = rejects._list

    def lost(spark, where, rows):
        if rows[0][-1]:
            raise RuntimeError("lost the driver")
        plain(spark, where, rows)

    with monkeypatch.context() as patch:
        patch.setattr(rejects, "_list", lost)
        with pytest.raises(RuntimeError):
            rejects.replay_rejects(spark, path, mend, score, table)
    assert store.read_telemetry(spark, table).count() == 32
    assert len(texts(spark, path)) == 13
    assert rejects.replay_rejects(spark, path, lambda v: v, score, table) == 13
    assert store.read_telemetry(spark, table).count() == 20
    assert rejects.replay_rejects(spark, path, mend, score, table) == 1
    assert store.read_telemetry(spark, table).count() == 32


def test_the_job(spark, places, capsys):
    table, path = places
    job.main(["--rejects", path])
    job.main(["--rejects", path, "--mend", "trim(LEADING '#' FROM value)", "--telemetry", table])
    assert capsys.readouterr().out.split() == ["unreadable:", "13", "unreadable:", "1"]
    assert store.read_telemetry(spark, table).count() == 32
    with pytest.raises(SystemExit):
        job.main(["--rejects", path, "--mend", "value"])
    job.main(["--rejects", scratch_dir(spark, "none")])
    assert capsys.readouterr().out.split()[-1] == "0"
