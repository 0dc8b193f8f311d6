"""Rules about one shot: who took it, from where, and what it was worth."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from swishline.functions.keys import key_hash
from swishline.schemas import (
    DEFAULT_PERIOD,
    DEFAULT_PLAYER,
    FAR_ZONE,
    GRADE_FLOORS,
    MADE,
    MISSED,
    THREE_POINT_LINE,
    ZONE_LIMITS,
)

# shot-type labels in order of precedence; pull-ups have none
LABELS = [
    ("is_dunk", "Dunk"),
    ("is_layup", "Layup"),
    ("is_hook", "Hook"),
    ("is_tip", "Tip"),
    ("is_fadeaway", "Fadeaway"),
    ("is_bank", "Bank"),
    ("is_alley_oop", "Alley Oop"),
    ("is_three", "3PT Jump Shot"),
]
PLAIN_LABEL = "Jump Shot"


def _first_match(cases: list[tuple[Column, str]], default: str) -> Column:
    (condition, value), *rest = cases
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def is_shot(message_type: Column) -> Column:
    return message_type.isin(MADE, MISSED)


def made(message_type: Column) -> Column:
    return F.when(message_type == MADE, 1).otherwise(0)


def result_text(message_type: Column) -> Column:
    return F.when(message_type == MADE, "Made Shot").otherwise("Missed Shot")


def beyond_arc(distance: Column) -> Column:
    return distance > THREE_POINT_LINE


def is_three(distance: Column) -> Column:
    return beyond_arc(distance).cast("int")


def is_home(home_description: Column) -> Column:
    """1 when the home side has any text, a block of the visitor's shot included."""
    return F.when(home_description.isNotNull() & (home_description != ""), 1).otherwise(0)


def served_game(game_id: Column) -> Column:
    """Game ids travel as text; a missing one is published as the text 'None'."""
    return F.coalesce(game_id.cast("string"), F.lit("None"))


def served_player(player: Column) -> Column:
    return F.coalesce(F.nullif(player, F.lit("")), F.lit(DEFAULT_PLAYER))


def served_period(period: Column) -> Column:
    return F.coalesce(F.nullif(period, F.lit(0)), F.lit(DEFAULT_PERIOD))


def shot_type_label() -> Column:
    """Readable shot type from the flag columns; the first raised flag wins."""
    return _first_match([(F.col(flag) != 0, text) for flag, text in LABELS], PLAIN_LABEL)


def expected_points(probability: Column, distance: Column) -> Column:
    return probability * F.when(beyond_arc(distance), 3).otherwise(2)


def heuristic_points(distance: Column) -> Column:
    """Expected points when there is no model: short shots 1.0, others 0.8."""
    return F.when(distance < 10, F.lit(1.0)).otherwise(F.lit(0.8))


def grade(points: Column) -> Column:
    return _first_match([(points > floor, g) for g, floor in GRADE_FLOORS.items()], "C")


def zone(distance: Column) -> Column:
    """Court zone; an unknown distance falls in the last one."""
    return _first_match([(distance <= limit, z) for z, limit in ZONE_LIMITS.items()], FAR_ZONE)


def court_angle(key: Column) -> Column:
    """Angle in [0, pi) that depends on the shot's key alone, so maps reproduce."""
    return key_hash(key) * F.lit(math.pi) / F.lit(float(2**32))


def court_x(distance: Column, angle: Column) -> Column:
    return distance * 10 * F.cos(angle)


def court_y(distance: Column, angle: Column) -> Column:
    return F.lit(-250.0) + distance * 10 * F.sin(angle)
