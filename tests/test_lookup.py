"""Rating look-ups: both plans give the same rows, hot players included."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from swishline.operators import lookup
from swishline.operators.lookup import RatingTable, attach_rating, skill_lookup_train, split_keys


@pytest.fixture(scope="module")
def shots(spark):
    """A third of the rows belong to one rated player, a tenth to one unrated,
    some to nobody; the rest is spread over 3000 players."""
    n = F.col("id")
    player = (
        F.when(n % 3 == 0, "star")
        .when(n % 10 == 1, "rookie")
        .when(n % 50 == 2, None)
        .otherwise(F.concat(F.lit("p"), n % 3000))
    )
    return spark.range(30_000).select(n.alias("shot"), player.alias("player"))


@pytest.fixture(scope="module")
def ratings(spark):
    some = spark.range(2000).select(
        F.concat(F.lit("p"), "id").alias("player"),
        (F.col("id") / 4000).alias("rating"),
        F.lit(9).cast("bigint").alias("total"),
    )
    star = spark.createDataFrame([("star", 0.6, 9000)], "player string, rating double, total bigint")
    return some.unionByName(star).persist()


def small_and_large(ratings):
    small = RatingTable.measured(ratings)
    large = RatingTable(ratings, lookup.MAX_BROADCAST_ROWS + 1, 0, small.shots)
    assert small.fits_broadcast and not large.fits_broadcast
    return small, large


def test_plans_agree(shots, ratings, rows):
    small, large = small_and_large(ratings)
    known = {r["player"]: r["rating"] for r in ratings.collect()}
    want = sorted(((s, p, known.get(p)) for s, p in shots.collect()), key=str)
    assert rows(attach_rating(shots, small)) == want
    assert rows(attach_rating(shots, large)) == want


def test_size_limits_by_bytes(spark):
    long_names = spark.range(3).select(F.lit("x" * 1000).alias("player"), F.lit(0.5).alias("rating"),
                                     F.lit(1).alias("total"))
    table = RatingTable.measured(long_names)
    assert table.rows == 3 and table.bytes >= 3000
    assert not RatingTable(long_names, 3, lookup.MAX_BROADCAST_BYTES + 1).fits_broadcast


def test_storing_measures(ratings, rows):
    stored = RatingTable.stored(ratings)
    measured = RatingTable.measured(ratings)
    assert (stored.rows, stored.bytes) == (measured.rows, measured.bytes) == (2001, stored.bytes)
    assert rows(stored.frame) == rows(ratings)


def test_large_plan_gathers_no_hot_player_and_no_unnamed_rows(shots, ratings):
    """No join key owns a noticeable share of the rows that are shuffled."""
    _, large = small_and_large(ratings)
    served = shots.withColumn(
        "player", F.when(F.col("player") == "rookie", None).otherwise(F.col("player"))
    ).withColumn("player", F.coalesce("player", F.lit("Unknown")))
    keyed = split_keys(served, large)
    assert keyed.where("player IN ('star', 'Unknown')").where("cold IS NOT NULL").count() == 0
    assert keyed.where("player = 'star' AND hot_rating IS NULL").count() == 0
    largest = keyed.groupBy("cold", "spread").count().agg(F.max("count")).first()[0]
    assert largest <= shots.count() / 1000


def test_train_rule(spark, ratings, rows):
    small, _ = small_and_large(ratings)
    frame = spark.createDataFrame([(1, "star"), (2, "nobody"), (3, None), (4, "")],
                                  "shot int, player string")
    got = rows(skill_lookup_train(frame, small, F.lit(0.4)))
    assert got == [(1, "star", 0.6), (2, "nobody", 0.4), (3, None, None), (4, "", 0.4)]


def test_large_plan_works_on_a_stream(spark, shots, ratings, rows, tmp_path):
    """The plan counts nothing, so a stream can use it, and the result is the batch's."""
    small, large = small_and_large(ratings)
    shots.repartition(3).write.parquet(f"{tmp_path}/shots")
    stream = spark.readStream.schema(shots.schema).parquet(f"{tmp_path}/shots")
    rated = lookup.skill_lookup_serve(stream, large).writeStream.format("parquet")
    rated = rated.option("checkpointLocation", f"{tmp_path}/offsets").trigger(availableNow=True)
    rated.start(f"{tmp_path}/out").awaitTermination()
    want = lookup.skill_lookup_serve(shots, small)
    assert rows(spark.read.parquet(f"{tmp_path}/out").select(*want.columns)) == rows(want)
