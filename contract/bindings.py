"""Plays, scored shots and telemetry as fixed projections of the ``events`` table.

FIXTURES.md section 2 gives the rules; ``oracle.py`` states them again for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swishline.functions import shots as S
from swishline.operators import plays as P
from swishline.operators.scoring import expected_points, shot_grade

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)

TEXT = """
concat('Player ', user_id, ' ', coalesce(
  CASE WHEN event_id % 13 <> 0 THEN concat(k % 35, '\\' ', element_at(
    array('Driving DUNK', 'Layup', 'Hook Shot', 'Tip Layup Shot', 'Fadeaway', 'Jump Bank Shot',
      'Alley Oop Dunk', 'Pull-Up Jump Shot', '3PT Jump Shot'),
    cast(event_id % 9 + 1 AS int))) END,
  'Layup'))
"""

PLAYS = [
    "event_id AS play_id",
    "lpad(cast(user_id % 40 AS string), 10, '0') AS game_id",
    """CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 2
         WHEN 'signup' THEN 3 WHEN 'error' THEN 5 END AS eventmsgtype""",
    "CASE WHEN k % 17 <> 0 THEN k % 5 END AS period",
    """CASE WHEN k % 33 = 0 THEN NULL WHEN k % 25 = 0 THEN 'n/a' WHEN k % 29 = 0 THEN '1:02:03'
         ELSE concat(k % 12, ':', lpad(cast(event_id % 60 AS string), 2, '0'))
       END AS pctimestring""",
    """CASE WHEN user_id % 2 = 0 THEN text WHEN event_id % 11 = 0 THEN 'Smith BLOCK (1 BLK)'
       END AS homedescription""",
    "CASE WHEN user_id % 2 = 1 THEN text END AS visitordescription",
    """CASE WHEN user_id % 50 = 0 THEN NULL WHEN user_id % 50 = 1 THEN ''
         ELSE concat('Player ', user_id) END AS player1_name""",
    "cast(ts AS timestamp) AS created_at",
]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _as_plays(events: DataFrame) -> DataFrame:
    parsed = events.selectExpr("*", "cast(get_json_object(props, '$.k') AS int) AS k")
    return parsed.selectExpr("*", f"{TEXT} AS text").selectExpr(*PLAYS)


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_plays(_events(spark, sf_dir))


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.shots(plays(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots with a closed-form probability ``p`` and their true ``label``."""
    return shots(spark, sf_dir).selectExpr(
        "*",
        "cast((cast(play_id * 37 % 100 AS double) + 0.5D) / 100 AS double) AS p",
        "cast(eventmsgtype = 1 AS int) AS label",
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the scorer would have stored had it predicted ``p``."""
    rows = shot_grade(expected_points(scored(spark, sf_dir)))
    return rows.select(
        F.col("play_id").cast("string").alias("shot_id"),
        "game_id",
        S.served_player(F.col("player1_name")).alias("player_name"),
        "shot_distance",
        "expected_points",
        "shot_grade",
        F.col("created_at").alias("event_time"),
        "created_at",
    )
