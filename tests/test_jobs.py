"""The four jobs one after the other, through their command lines."""

from __future__ import annotations

import pytest

from contract import bindings
from conftest import SMALL
from swishline.plans import dashboard, live, publish, retrain, score
from swishline.sources.plays import write_plays
from swishline.sources.scratch import scratch_dir
from swishline.schemas import PLAYS
from swishline.sources.telemetry import read_telemetry
from swishline.streaming import live as reports


def test_pipeline(spark, tmp_path, capsys):
    base = str(tmp_path)
    write_plays(bindings.plays(spark, SMALL).select(*PLAYS.fieldNames()), f"{base}/plays")
    stream = ["--transport", "files", "--location", f"{base}/stream"]

    retrain.main(["--plays", f"{base}/plays", "--artifacts", f"{base}/artifacts", "--rounds", "2"])
    assert "best round" in capsys.readouterr().out
    publish.main(["--plays", f"{base}/plays", *stream])
    score.main([*stream, "--artifacts", f"{base}/artifacts", "--telemetry", f"{base}/telemetry",
                "--checkpoint", f"{base}/offsets", "--start", "earliest", "--once"])
    stored = read_telemetry(spark, f"{base}/telemetry")
    assert stored.count() == bindings.shots(spark, SMALL).count()

    live.main([*stream, "--artifacts", f"{base}/artifacts", "--out", f"{base}/live",
               "--checkpoint", f"{base}/live-offsets", "--start", "earliest", "--once",
               "--late-by", "3650 days"])
    head = reports.headline(reports.running_totals_now(spark, f"{base}/live/totals")).first()
    assert head["total_shots"] == stored.count()
    minutes = reports.shots_per_minute_now(spark, f"{base}/live/minutes")
    assert minutes.agg({"shots": "sum"}).first()[0] == stored.count()
    points = stored.agg({"expected_points": "avg"}).first()[0]
    assert head["avg_xp"] == pytest.approx(points)

    live.main([*stream, "--out", f"{base}/live", "--show"])
    shown = capsys.readouterr().out
    assert "headline" in shown and "zones" in shown and str(stored.count()) in shown

    dashboard.main(["--telemetry", f"{base}/telemetry", "--out", f"{base}/reports"])
    assert spark.read.json(f"{base}/reports/header").first()["total_shots"] == stored.count()
    assert spark.read.json(f"{base}/reports/recent").count() == 20
    capsys.readouterr()
    dashboard.main(["--telemetry", f"{base}/telemetry", "--as-of", "2024-01-20T00:00:00"])
    printed = capsys.readouterr().out
    assert "only showing" not in printed and printed.count("\n") > 200


def test_scratch_needs_the_shared_folder_on_a_cluster(spark, monkeypatch):
    from swishline.sources import scratch

    class Elsewhere:
        master = "spark://somewhere:7077"

    class Session:
        sparkContext = Elsewhere()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: None)})()

    with pytest.raises(RuntimeError, match=scratch.SETTING):
        scratch_dir(Session(), "x")
