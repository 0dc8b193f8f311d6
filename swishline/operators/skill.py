"""Player ratings: made share, pulled towards the league average."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swishline.functions import shots as S
from swishline.operators.plays import filter_shots
from swishline.schemas import LEAGUE_RATING, PRIOR_SHOTS


def player_totals(plays: DataFrame) -> DataFrame:
    """Made and total per named player, over all shots, distance or not.

    Counts combine on the map side: a star player reaches the reducer as one
    row per input task.
    """
    named = filter_shots(plays).where(F.col("player1_name") != "")
    return named.groupBy(F.col("player1_name").alias("player")).agg(
        F.sum(S.made(F.col("eventmsgtype"))).alias("made"),
        F.count(F.lit(1)).alias("total"),
    )


def league_avg(totals: DataFrame) -> DataFrame:
    """One row: made share over all named players' shots."""
    share = F.try_divide(F.sum("made"), F.sum("total"))
    return totals.agg(F.coalesce(share, F.lit(LEAGUE_RATING)).alias("league_avg"))


def league_value(totals: DataFrame) -> Column:
    """The league average as a scalar subquery; shares the totals' shuffle."""
    return league_avg(totals).scalar()


def player_skill(totals: DataFrame) -> DataFrame:
    """Rating per player, with the league average weighing as much as 50 shots."""
    smoothed = (F.col("made") + PRIOR_SHOTS * league_value(totals)) / (F.col("total") + PRIOR_SHOTS)
    return totals.select("player", "made", "total", F.round(smoothed, 4).alias("rating"))
