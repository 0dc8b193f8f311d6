"""From raw plays to shots, events and feature rows. Narrow: nothing shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swishline.functions import shots as S
from swishline.functions import text as X
from swishline.schemas import (
    CORRUPT,
    DEFAULT_DISTANCE,
    DEFAULT_PERIOD,
    DEFAULT_PLAYER,
    DEFAULT_SECONDS,
    EVENT_FIELDS,
    EVENT_JSON,
    FEATURES,
    SHOT_TYPES,
)


def filter_shots(plays: DataFrame) -> DataFrame:
    """Made and missed shots; fouls, rebounds and the rest go."""
    return plays.where(S.is_shot(F.col("eventmsgtype")))


def combine_description(plays: DataFrame) -> DataFrame:
    return plays.withColumn(
        "description",
        X.combined_description(F.col("homedescription"), F.col("visitordescription")),
    )


def extract_distance(plays: DataFrame) -> DataFrame:
    return plays.withColumn("shot_distance", X.distance_feet(F.col("description")))


def require_distance(plays: DataFrame) -> DataFrame:
    return plays.where(F.col("shot_distance").isNotNull())


def shots(plays: DataFrame) -> DataFrame:
    """Shots that name a distance: the rows every later step works on."""
    return require_distance(extract_distance(combine_description(filter_shots(plays))))


def result_label(plays: DataFrame) -> DataFrame:
    return plays.withColumn("result", S.result_text(F.col("eventmsgtype")))


def shot_type_flags(plays: DataFrame) -> DataFrame:
    """Eight 0/1 columns. Names count too: a player called Banks raises is_bank."""
    return plays.withColumns(
        {flag: X.shot_type_flag(F.col("description"), flag) for flag in SHOT_TYPES}
    )


def seconds_remaining(plays: DataFrame) -> DataFrame:
    return plays.withColumn("seconds_remaining", X.clock_seconds(F.col("pctimestring")))


def is_three(rows: DataFrame) -> DataFrame:
    return rows.withColumn("is_three", S.is_three(F.col("shot_distance")))


def is_home(plays: DataFrame) -> DataFrame:
    return plays.withColumn("is_home", S.is_home(F.col("homedescription")))


def event_defaults(plays: DataFrame) -> DataFrame:
    """What the publisher fills in: player, period and the text form of game_id."""
    return plays.withColumns(
        {
            "game_id": S.served_game(F.col("game_id")),
            "player": S.served_player(F.col("player1_name")),
            "period": S.served_period(F.col("period")),
        }
    )


def described_shots(plays: DataFrame) -> DataFrame:
    """Shots with every column that is derived from one raw row alone."""
    rows = shots(plays)
    for step in (result_label, shot_type_flags, seconds_remaining, is_three, is_home):
        rows = step(rows)
    return rows


EVENT_KEY = "event_key"


def build_event(plays: DataFrame, at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 17-field shot event. ``at`` is its time; by default, now.

    ``keep`` names source columns to carry along, such as the play's own key.
    """
    stamp = F.current_timestamp() if at is None else at
    rows = event_defaults(described_shots(plays)).withColumn("distance", F.col("shot_distance"))
    rows = rows.withColumn("timestamp", F.unix_micros(stamp) / F.lit(1e6))
    return rows.select(*keep, *EVENT_FIELDS)


def encode_events(events: DataFrame) -> DataFrame:
    """One JSON text per event, in the column a Kafka or text sink expects.

    A column ``event_key``, if there is one, goes along: it tells equal events apart.
    """
    key = [c for c in events.columns if c == EVENT_KEY]
    return events.select(F.to_json(F.struct(*EVENT_FIELDS, *key)).alias("value"))


def decode_events(messages: DataFrame) -> DataFrame:
    """Parse JSON messages. Unreadable ones keep their text in the corrupt column."""
    parsed = F.from_json(
        "value", EVENT_JSON, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return messages.withColumn("event", parsed)


def readable(decoded: DataFrame) -> DataFrame:
    """Events that parsed and name a game, the one field that has no default."""
    return decoded.where(is_readable()).select(
        *[c for c in decoded.columns if c not in ("value", "event")],
        *[F.col(f"event.{name}") for name in EVENT_FIELDS],
    )


def unreadable(decoded: DataFrame) -> DataFrame:
    return decoded.where(~is_readable()).drop("event")


def is_readable() -> Column:
    """Condition on a decoded message."""
    return F.coalesce(
        F.col("event").isNotNull()
        & F.col(f"event.{CORRUPT}").isNull()
        & F.col("event.game_id").isNotNull(),
        F.lit(False),
    )


def event_field_defaults(events: DataFrame) -> DataFrame:
    """What the scorer fills in for absent fields; numbers become integers.

    ``distance`` stays a double until it is stored, so 23.5 ft counts as a three.
    """
    whole = {
        "period": DEFAULT_PERIOD,
        "seconds_remaining": DEFAULT_SECONDS,
        **{flag: 0 for flag in ("is_three", *SHOT_TYPES, "is_home")},
    }
    return events.withColumns(
        {
            "player": F.coalesce(F.col("player"), F.lit(DEFAULT_PLAYER)),
            "distance": F.coalesce(F.col("distance"), F.lit(DEFAULT_DISTANCE).cast("double")),
            **{
                name: F.coalesce(F.col(name).try_cast("int"), F.lit(default))
                for name, default in whole.items()
            },
        }
    )


def shot_type_label(rows: DataFrame) -> DataFrame:
    return rows.withColumn("shot_type", S.shot_type_label())


def served_inputs(plays: DataFrame) -> DataFrame:
    """Shots with the publisher's defaults: what a scorer would be sent."""
    rows = event_defaults(described_shots(plays))
    return rows.withColumn("label", S.made(F.col("eventmsgtype")))


def raw_inputs(plays: DataFrame) -> DataFrame:
    """Shots as the trainer reads them: gaps in player, period and clock stay null."""
    rows = described_shots(plays).withColumns(
        {
            "player": F.col("player1_name"),
            "seconds_remaining": F.when(
                F.col("pctimestring").isNotNull(), F.col("seconds_remaining")
            ),
        }
    )
    return rows.withColumn("label", S.made(F.col("eventmsgtype")))


def feature_columns(rows: DataFrame, keep: tuple[str, ...] = (), label: bool = True) -> DataFrame:
    """Model inputs in model order, as doubles, after the ``keep`` columns."""
    target = [F.col("label").cast("int").alias("label")] if label else []
    return rows.select(*keep, *[F.col(name).cast("double").alias(name) for name in FEATURES], *target)
