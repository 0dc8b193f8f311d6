"""Golden vectors of the scalar rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from swishline.functions import shots as S
from swishline.functions import text as X
from swishline.functions.keys import key_hash, key_percent
from swishline.operators import plays as P
from swishline.operators.lookup import skill_lookup_serve
from swishline.schemas import SHOT_TYPES


def evaluate(spark, values, kind, rule):
    """Apply a rule to each value; results in the order of the values."""
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r["out"] for r in frame.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_distance(spark):
    texts = ["MISS Foo 26' 3PT", "Foo Layup", "", None, "A 12' then 7'", "x 99999999999' y", "9 ft"]
    assert evaluate(spark, texts, "string", X.distance_feet) == [26, None, None, None, 12, None, None]


def test_clock(spark):
    clocks = ["12:00", "0:05", "7:3", None, "n/a", "1:02:03", "5.5:10", "", ":", "5:", " 1 : +2 ",
              "-1:30", "99999999999:00", "99999999:00"]
    assert evaluate(spark, clocks, "string", X.clock_seconds) == [
        720, 5, 423, 360, 360, 360, 360, 360, 360, 360, 62, -30, 360, 360]


def test_three(spark):
    assert evaluate(spark, [23, 24, None], "int", S.is_three) == [0, 1, None]


@pytest.mark.parametrize(
    "text, raised",
    [
        ("Banks 5' Tip Layup", {"is_tip", "is_layup", "is_bank"}),
        ("Fade Away", {"is_fadeaway"}),
        ("FADEAWAY", {"is_fadeaway"}),
        ("Pull up", {"is_pullup"}),
        ("pull-up", {"is_pullup"}),
        ("Pullup", {"is_pullup"}),
        ("Alley Oop Dunk", {"is_alley_oop", "is_dunk"}),
        ("Hook Shot", {"is_hook"}),
        (None, set()),
        ("Jump Shot", set()),
    ],
)
def test_shot_type_flags(spark, text, raised):
    frame = spark.createDataFrame([(text,)], "description string")
    flags = P.shot_type_flags(frame).first().asDict()
    assert {f for f in SHOT_TYPES if flags[f]} == raised


def test_home(spark):
    assert evaluate(spark, [None, "", "x"], "string", S.is_home) == [0, 0, 1]


def test_served_values(spark):
    assert evaluate(spark, [None, "", "A"], "string", S.served_player) == ["Unknown", "Unknown", "A"]
    assert evaluate(spark, [None, 0, 3], "int", S.served_period) == [1, 1, 3]
    assert evaluate(spark, ["0022300001", None], "string", S.served_game) == ["0022300001", "None"]


def test_result(spark):
    assert evaluate(spark, [1, 2], "int", S.result_text) == ["Made Shot", "Missed Shot"]
    assert evaluate(spark, [1, 2, 3, None], "int", S.is_shot) == [True, True, False, None]


def test_expected_points(spark):
    frame = spark.createDataFrame([(0, 0.4, 23), (1, 0.4, 24)], "i int, p double, d int")
    points = S.expected_points(F.col("p"), F.col("d"))
    got = [r[0] for r in frame.orderBy("i").select(points).collect()]
    assert got == pytest.approx([0.8, 1.2])


def test_heuristic_and_its_grade(spark):
    assert evaluate(spark, [9, 10], "int", S.heuristic_points) == [1.0, 0.8]
    assert evaluate(spark, [9, 10], "int", lambda d: S.grade(S.heuristic_points(d))) == ["B", "C"]


def test_grade_edges(spark):
    points = [1.1001, 1.1, 0.9001, 0.9, 0.0]
    assert evaluate(spark, points, "double", S.grade) == ["A", "B", "B", "C", "C"]


def test_zones(spark):
    zones = evaluate(spark, [3, 4, 10, 11, 16, 17, 23, 24, None], "int", S.zone)
    assert [z.split(" ")[0] for z in zones] == [
        "Rim", "Paint", "Paint", "Mid-Range", "Mid-Range", "Long", "Long", "3-Pointer", "3-Pointer"]


def test_shot_type_label(spark):
    flags = [f for f in SHOT_TYPES] + ["is_three"]
    cases = [({"is_dunk", "is_alley_oop"}, "Dunk"), ({"is_three"}, "3PT Jump Shot"),
             (set(), "Jump Shot"), ({"is_pullup"}, "Jump Shot"), ({"is_tip", "is_three"}, "Tip")]
    data = [tuple(int(f in raised) for f in flags) + (want,) for raised, want in cases]
    frame = spark.createDataFrame(data, [*flags, "want"])
    for row in P.shot_type_label(frame).collect():
        assert row["shot_type"] == row["want"]


def test_event_field_defaults(spark):
    message = spark.createDataFrame([("k", '{"game_id":"1"}')], "shot_id string, value string")
    event = P.event_field_defaults(P.readable(P.decode_events(message)))
    got = skill_lookup_serve(event, None).first().asDict()
    assert (got["distance"], got["period"], got["seconds_remaining"]) == (15, 1, 360)
    assert got["player"] == "Unknown" and got["player_skill_rating"] == 0.45
    assert not any(got[f] for f in (*SHOT_TYPES, "is_three", "is_home"))


def test_unreadable_messages(spark):
    texts = ["", "not json", '{"player":"no game"}', '{"game_id":"1","distance":"24"}', "[1]", "null",
             '{"game_id":"1","distance":24.0}', '{"game_id":"1","distance":24}']
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    decoded = P.decode_events(messages)
    assert P.unreadable(decoded).count() == 6
    assert [r["distance"] for r in P.readable(decoded).collect()] == [24.0, 24.0]


def test_key_hash_is_stable(spark):
    import hashlib

    keys = ["0", "1", "shot-17"]
    want = [int(hashlib.md5(f"42:{k}".encode()).hexdigest()[:8], 16) for k in keys]
    assert evaluate(spark, keys, "string", key_hash) == want
    assert evaluate(spark, keys, "string", key_percent) == [w % 100 for w in want]
