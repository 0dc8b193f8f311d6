"""From served events to telemetry: rating, probability, expected points, grade."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swishline.functions import shots as S
from swishline.operators.lookup import RatingTable, skill_lookup_serve
from swishline.operators.plays import event_field_defaults
from swishline.schemas import FEATURES, TELEMETRY


def score_shots(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``p``, the probability that the shot is made; keeps the input columns."""
    scored = model.transform(features)
    p = vector_to_array(F.col("probability"))[1]
    return scored.select(*features.columns, p.alias("p"))


def expected_points(rows: DataFrame) -> DataFrame:
    value = S.expected_points(F.col("p"), F.col("shot_distance"))
    return rows.withColumn("expected_points", value)


def heuristic_xp(rows: DataFrame) -> DataFrame:
    return rows.withColumn("expected_points", S.heuristic_points(F.col("shot_distance")))


def shot_grade(rows: DataFrame) -> DataFrame:
    return rows.withColumn("shot_grade", S.grade(F.col("expected_points")))


def score_events(
    events: DataFrame,
    model: PipelineModel | None,
    ratings: RatingTable | None,
    created_at: Column | None = None,
) -> DataFrame:
    """Events with ``shot_id`` to telemetry rows. Without a model, the heuristic.

    ``created_at`` is the time of storage: now, unless the caller sets it.
    """
    rows = event_field_defaults(events).withColumn("shot_distance", F.col("distance"))
    if model is None:
        rows = heuristic_xp(rows)
    else:
        rated = skill_lookup_serve(rows, ratings)
        inputs = rated.withColumns({name: F.col(name).cast("double") for name in FEATURES})
        rows = expected_points(score_shots(inputs, model))
    stored = shot_grade(rows).withColumns(
        {
            "player_name": F.col("player"),
            "shot_distance": F.col("shot_distance").cast("int"),
            "event_time": event_time(),
        }
    )
    stamp = F.current_timestamp() if created_at is None else created_at
    return stored.withColumn("created_at", stamp).select(*TELEMETRY.fieldNames())


def event_time() -> Column:
    """The event's own epoch seconds as a timestamp, to the microsecond."""
    return F.timestamp_micros(F.round(F.col("timestamp") * 1e6).cast("bigint"))
