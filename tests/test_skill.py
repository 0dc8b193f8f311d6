from __future__ import annotations

import pytest

from conftest import SMALL
from contract import bindings
from swishline.operators.skill import league_avg, player_skill, player_totals

SCHEMA = "eventmsgtype int, player1_name string"


def test_smoothing_golden(spark):
    shots = [(1, "a")] * 10 + [(2, "b")] * 10
    frame = spark.createDataFrame(shots, SCHEMA)
    got = {r["player"]: r["rating"] for r in player_skill(player_totals(frame)).collect()}
    assert got == {"a": 0.5833, "b": 0.4167}


def test_no_shots_gives_the_league_default(spark):
    frame = spark.createDataFrame([(3, "a"), (1, ""), (2, None)], SCHEMA)
    totals = player_totals(frame)
    assert totals.count() == 0
    assert league_avg(totals).first()[0] == 0.45
    assert player_skill(totals).count() == 0


def test_ratings_lie_between_raw_and_league_rate(plays):
    totals = player_totals(plays)
    league = league_avg(totals).first()[0]
    for r in player_skill(totals).collect():
        raw = r["made"] / r["total"]
        assert min(raw, league) - 1e-4 <= r["rating"] <= max(raw, league) + 1e-4


def test_totals_count_shots_without_distance(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "a"), (5, "a")], SCHEMA)
    assert player_totals(frame).select("made", "total").first() == (1, 2)


def test_matches_brute_force(plays):
    stats: dict[str, list[int]] = {}
    for kind, name in plays.select("eventmsgtype", "player1_name").collect():
        if kind in (1, 2) and name:
            entry = stats.setdefault(name, [0, 0])
            entry[0] += kind == 1
            entry[1] += 1
    league = sum(m for m, _ in stats.values()) / sum(t for _, t in stats.values())
    got = {r["player"]: r["rating"] for r in player_skill(player_totals(plays)).collect()}
    want = {n: (m + 50 * league) / (t + 50) for n, (m, t) in stats.items()}
    assert got.keys() == want.keys()
    for name in got:
        assert got[name] == pytest.approx(want[name], abs=1e-4)


def test_league_average_shares_the_totals_shuffle(spark):
    # another folder than that of the fixtures, whose plays are cached
    ratings = player_skill(player_totals(bindings.plays(spark, SMALL.replace("0.001", "0.01"))))
    ratings.collect()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    assert "ReusedExchange" in ratings._jdf.queryExecution().explainString(mode)
