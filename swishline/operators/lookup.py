"""Attach player ratings to rows without ever hauling a hot player to one task.

Two plans, chosen from the measured size of the rating table:

* it fits: broadcast it, and the rows never move;
* it does not: split the players by the shots that their ratings stand on. One that
  owns more than 1/1000 of those is hot; there are fewer than 1000 of them whatever
  the data, so their ratings are broadcast. Rows of other players shuffle by player.
  Rows that need no second look-up (hot, unnamed, or of the default player) are
  spread by a hash.

Neither plan counts the rows, so both work on a batch, on a micro-batch, which is then
read once, and on a stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swishline.schemas import DEFAULT_PLAYER, LEAGUE_RATING
from swishline.sources.scratch import written

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# A player with more than this share of the rated shots is hot. N of them would
# own more than N/1000 of those shots, so there are always fewer than 1000.
HOT_SHARE = 1 / 1000
# keys that rows without a look-up are spread over
SPREAD = 1 << 20


@dataclass(frozen=True)
class RatingTable:
    """Ratings (player, rating and the shots behind it, total) with their measured size.

    ``frame`` should be a stored table: it is read once to measure it and again
    by each join.
    """

    frame: DataFrame
    rows: int
    bytes: int
    shots: int = 0

    @classmethod
    def measured(cls, frame: DataFrame) -> RatingTable:
        """Measure a table that is stored already."""
        text_bytes = F.sum(F.octet_length("player") + 24)
        size = frame.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(text_bytes, F.lit(0)).alias("bytes"),
            F.coalesce(F.sum("total"), F.lit(0)).alias("shots"),
        ).first()
        return cls(frame, size["rows"], size["bytes"], size["shots"])

    @classmethod
    def stored(cls, ratings: DataFrame) -> RatingTable:
        """Store computed ratings, with all their columns, and measure them."""
        return cls.measured(written(ratings, "ratings"))

    @property
    def fits_broadcast(self) -> bool:
        return self.rows <= MAX_BROADCAST_ROWS and self.bytes <= MAX_BROADCAST_BYTES


def attach_rating(rows: DataFrame, ratings: RatingTable) -> DataFrame:
    """Add a nullable ``rating``, matched on ``player``. Keeps every row."""
    if ratings.fits_broadcast:
        table = ratings.frame.select("player", "rating")
        return rows.join(F.broadcast(table), "player", "left").select(*rows.columns, "rating")
    return _attach_split(rows, ratings)


def hot_ratings(ratings: RatingTable) -> DataFrame:
    """Ratings of the hot players (fewer than 1000), and of the default player if rated."""
    hot = (F.col("total") > ratings.shots * HOT_SHARE) | (F.col("player") == DEFAULT_PLAYER)
    return ratings.frame.where(hot).select(
        F.col("player").alias("hot"), F.col("rating").alias("hot_rating")
    )


def split_keys(rows: DataFrame, ratings: RatingTable) -> DataFrame:
    """Rows with the rating of hot players and the keys the others shuffle by:
    ``cold``, null where there is nothing left to look up, and ``spread``."""
    marked = rows.join(F.broadcast(hot_ratings(ratings)), F.col("player") == F.col("hot"), "left")
    cold = F.when(F.col("hot").isNull() & (F.col("player") != DEFAULT_PLAYER), F.col("player"))
    spread = F.when(cold.isNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD))).otherwise(0)
    return marked.withColumns({"cold": cold, "spread": spread})


def _attach_split(rows: DataFrame, ratings: RatingTable) -> DataFrame:
    keyed = split_keys(rows, ratings)
    # a second key of value 0, in a form that the optimizer leaves a join key
    zero = F.length("player").cast("bigint") * 0
    joined = keyed.join(
        ratings.frame.select(F.col("player").alias("rated"), "rating", zero.alias("zero")),
        (F.col("cold") == F.col("rated")) & (F.col("spread") == F.col("zero")),
        "left",
    )
    return joined.select(*rows.columns, F.coalesce("hot_rating", "rating").alias("rating"))


def skill_lookup_train(rows: DataFrame, ratings: RatingTable, league: Column) -> DataFrame:
    """Training rule: an unrated player gets the league average, a null player none."""
    rated = attach_rating(rows, ratings)
    value = F.when(F.col("player").isNotNull(), F.coalesce(F.col("rating"), league))
    return rated.withColumn("player_skill_rating", value).drop("rating")


def skill_lookup_serve(rows: DataFrame, ratings: RatingTable | None) -> DataFrame:
    """Serving rule: whoever has no rating gets the fixed league rating."""
    fixed = F.lit(LEAGUE_RATING)
    if ratings is None:
        return rows.withColumn("player_skill_rating", fixed)
    rated = attach_rating(rows, ratings)
    return rated.withColumn("player_skill_rating", F.coalesce("rating", fixed)).drop("rating")
