"""Job: learn ratings and a model from all plays, publish both, report quality."""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swishline.operators.evaluation import class_balance, evaluate
from swishline.operators.lookup import RatingTable, skill_lookup_serve, skill_lookup_train
from swishline.operators.model import (
    Boosting,
    feature_importance,
    train_boosted,
    train_logistic,
    what_if_scores,
)
from swishline.operators.plays import feature_columns, raw_inputs, served_inputs
from swishline.operators.sampling import train_test_split
from swishline.operators.scoring import score_shots
from swishline.operators.skill import league_value, player_skill, player_totals
from swishline.plans.options import print_all
from swishline.session import get_session
from swishline.sources.artifacts import publish_model, publish_ratings
from swishline.sources.plays import scan_plays
from swishline.sources.scratch import spread, written


@dataclass(frozen=True)
class Retrained:
    """What a training run leaves behind; the frames are small reports, but for the
    stored feature rows with their split."""

    model: PipelineModel
    ratings: RatingTable
    features: DataFrame
    losses: list[float]
    best_round: int | None
    balance: DataFrame
    metrics: DataFrame
    importance: DataFrame
    scenarios: DataFrame


def rated_players(plays: DataFrame) -> RatingTable:
    """Stored table of player, made, total and rating: one row per named player."""
    return RatingTable.stored(player_skill(player_totals(plays)))


def feature_rows(
    plays: DataFrame,
    ratings: RatingTable,
    keep: tuple[str, ...] = (),
    legacy_training: bool = False,
) -> DataFrame:
    """Label and model inputs per shot.

    By default gaps are filled as they are when serving, so the model meets the
    same rows in both places. ``legacy_training`` leaves them null instead, and
    gives unrated players the league average in place of the fixed rating.
    """
    if legacy_training:
        league = league_value(ratings.frame)
        rated = skill_lookup_train(raw_inputs(plays), ratings, league)
    else:
        rated = skill_lookup_serve(served_inputs(plays), ratings)
    return feature_columns(rated, keep)


def split_features(
    plays: DataFrame, ratings: RatingTable, key: Column, legacy_training: bool = False
) -> DataFrame:
    """Feature rows with their split, stored and dealt evenly: training reads them many times."""
    keyed = plays.withColumn("shot_key", key)
    features = feature_rows(keyed, ratings, ("shot_key",), legacy_training)
    stored = written(train_test_split(features, F.col("shot_key")), "features")
    return written(spread(stored), "split", "split")


def retrain(
    spark: SparkSession,
    plays: DataFrame,
    artifacts: str,
    key: Column,
    learner: str = "boosted",
    settings: Boosting = Boosting(),
    legacy_training: bool = False,
) -> Retrained:
    """The whole training run. ``key`` identifies a play and fixes its split."""
    ratings = rated_players(plays)
    publish_ratings(ratings.frame, artifacts)

    features = split_features(plays, ratings, key, legacy_training)
    train = features.where(F.col("split") == "train")
    test = features.where(F.col("split") == "test")
    if learner == "boosted":
        fitted = train_boosted(train, test, settings, impute=legacy_training)
        model, losses, best = fitted.model, fitted.losses, fitted.best_round
    else:
        model, losses, best = train_logistic(train, impute=legacy_training), [], None
    publish_model(spark, model, artifacts)

    scored = written(score_shots(test, model).select("label", "p"), "scored")
    return Retrained(
        model=model,
        ratings=ratings,
        features=features,
        losses=losses,
        best_round=best,
        balance=class_balance(features),
        metrics=evaluate(scored),
        importance=feature_importance(spark, model),
        scenarios=what_if_scores(spark, model),
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--plays", required=True, help="CSV file or folder")
    parser.add_argument("--artifacts", required=True, help="root of the artifacts")
    parser.add_argument("--learner", choices=["boosted", "logistic"], default="boosted")
    parser.add_argument("--rounds", type=int, default=Boosting.rounds)
    parser.add_argument("--legacy-training", action="store_true")
    args = parser.parse_args(argv)

    spark = get_session("retrain")
    plays = scan_plays(spark, args.plays)
    done = retrain(
        spark,
        plays,
        args.artifacts,
        # the files hold no key of their own: equal rows share a side of the split
        key=F.xxhash64(*plays.columns),
        learner=args.learner,
        settings=Boosting(rounds=args.rounds),
        legacy_training=args.legacy_training,
    )
    print(f"best round: {done.best_round}")
    for report in (done.balance, done.metrics, done.importance, done.scenarios):
        print_all(report)


if __name__ == "__main__":
    main()
