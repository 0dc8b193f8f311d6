"""Models on plays with a planted signal: close shots and even players score."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import functions as F

from conftest import SMALL
from contract import bindings
from contract import queries as contract
from swishline.operators import evaluation as E
from swishline.operators import model as M
from swishline.operators import nodes as N
from swishline.operators.scoring import score_shots
from swishline.plans.retrain import feature_rows, rated_players, retrain, split_features
from swishline.schemas import FEATURES
from swishline.sources import scratch
from swishline.sources.artifacts import load_model, load_ratings
from swishline.sources.scratch import even_tasks, scratch_dir, written


@pytest.fixture(scope="module")
def signal_plays(spark):
    plays = bindings.plays(spark, SMALL)
    feet = F.coalesce(F.regexp_extract(
        F.concat_ws("", "homedescription", "visitordescription"), "([0-9]+)'", 1
    ).try_cast("int"), F.lit(15))
    noise = F.pmod(F.xxhash64("play_id"), F.lit(100))
    made = noise < 90 - feet * 2
    plays = plays.where("eventmsgtype IN (1, 2)")
    return written(plays.withColumn("eventmsgtype", F.when(made, 1).otherwise(2)), "signal")


@pytest.fixture(scope="module")
def split(signal_plays):
    rows = split_features(signal_plays, rated_players(signal_plays), F.col("play_id"))
    return rows.where("split = 'train'"), rows.where("split = 'test'")


def test_patience():
    assert M.best_round([3, 2, 1], 10) == 3
    assert M.best_round([3, 1, 2, 2, 2, 0], 3) == 2
    assert M.best_round([3, 1, 2, 2, 2, 0], 4) == 6
    assert M.best_round([1], 10) == 1


def test_boosted_beats_chance(split):
    done = M.train_boosted(*split, M.Boosting(rounds=8, depth=3))
    assert len(done.losses) == 8 and 1 <= done.best_round <= 8
    assert done.model.stages[-1].getNumTrees == done.best_round
    scored = score_shots(split[1], done.model)
    assert scored.where("p < 0 OR p > 1").count() == 0
    assert E.eval_auc(scored).first()[0] > 0.6
    top = M.feature_importance(split[0].sparkSession, done.model).collect()
    assert sorted(r["feature"] for r in top) == sorted(FEATURES)
    assert top == sorted(top, key=lambda r: (-r["importance"], r["feature"]))
    assert top[0]["feature"] in ("shot_distance", "is_three")


def test_a_shortened_model_is_the_fit_of_fewer_rounds(spark, split):
    train, valid = split
    rounds = M.Boosting(rounds=5, depth=3, patience=100)
    rows = M._weighted(train, M._prepared(train, False), M.positive_weight(train))
    learner = GBTClassifier(maxIter=5, maxDepth=3, stepSize=rounds.rate, subsamplingRate=0.8,
                            featureSubsetStrategy="0.8", weightCol="weight", seed=rounds.seed)
    short = M.shortened(learner.fit(rows), 3)
    again = learner.copy({learner.maxIter: 3}).fit(rows)
    assert short.getNumTrees == 3
    assert short.featureImportances == again.featureImportances
    path = scratch_dir(spark, "short")
    short.save(path)
    loaded = GBTClassificationModel.load(path)
    for model in (short, loaded):
        got = [r[0] for r in model.transform(rows).select("probability").collect()]
        assert got == [r[0] for r in again.transform(rows).select("probability").collect()]


def test_fits_grow_in_stages():
    assert M.stops(100, 10) == [12, 25, 50, 100]
    assert M.stops(8, 10) == [8]
    assert M.stops(40, 3) == [5, 10, 20, 40]


def test_stages_keep_what_the_full_fit_cut_keeps(split, monkeypatch):
    settings = M.Boosting(rounds=24, depth=3, patience=3, rate=0.9)
    staged = M.train_boosted(*split, settings)
    assert len(staged.losses) < 24  # patience ran out in an early stage
    monkeypatch.setattr(M, "stops", lambda rounds, patience: [rounds])
    full = M.train_boosted(*split, settings)
    assert staged.best_round == full.best_round
    assert staged.losses == full.losses[: len(staged.losses)]
    both = [
        [r["p"] for r in score_shots(split[1], m.model).orderBy("shot_key").collect()]
        for m in (staged, full)
    ]
    assert both[0] == both[1]


@pytest.mark.parametrize(
    "losses, fits",
    [
        # still falling after the first stage: all rounds next, no stages between
        ([100 - n for n in range(100)], [12, 100]),
        # one rise near its end: one stage more, and then all
        ([*range(100, 89, -1), 95, *range(80, -8, -1)], [12, 25, 100]),
        # patience runs out in the first stage, or in the second
        ([1, *[2] * 99], [12]),
        ([9, 8, 7, 6, 5, *[6] * 95], [12, 25]),
    ],
)
def test_at_most_three_fits(split, monkeypatch, losses, fits):
    seen = []

    class Fitted:
        def __init__(self, rounds):
            seen.append(rounds)
            self.rounds = rounds

        def evaluateEachIteration(self, rows):
            return losses[: self.rounds]

    fit = lambda self, rows, params=None: Fitted(self.getMaxIter())
    monkeypatch.setattr(M.GBTClassifier, "fit", fit)
    monkeypatch.setattr(M, "shortened", lambda fitted, rounds: fitted)
    monkeypatch.setattr(M, "PipelineModel", lambda stages: stages[-1])
    monkeypatch.setattr(M, "_weighted", lambda rows, stages, weight: rows)
    done = M.train_boosted(*split)
    assert seen == fits
    assert done.best_round == M.best_round(losses, 10)


def test_rows_to_train_on_are_dealt_evenly(spark, signal_plays, monkeypatch):
    """Small tables make one task of a read, however many cores there are."""
    assert even_tasks(0, 12) == even_tasks(20_000, 12) == 1
    assert even_tasks(50_000, 12) == 3
    assert even_tasks(900_000, 12) == 12
    assert even_tasks(36_000_000, 12) == 36
    monkeypatch.setattr(scratch, "LEAST_TASK_ROWS", 10)
    one = signal_plays.coalesce(1)
    rows = split_features(one, rated_players(one), F.col("play_id"))
    for part in ("train", "test"):
        sizes = rows.where(F.col("split") == part).groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in sizes.collect()]
        assert len(sizes) == 8
        assert max(sizes) < 2 * min(sizes) + 20
    shots = feature_rows(one, rated_players(one)).count()
    assert rows.count() == shots and rows.select("shot_key").distinct().count() == shots


@pytest.fixture(scope="module")
def boosted(split):
    return M.train_boosted(*split, M.Boosting(rounds=6, depth=4))


def probabilities(frame, key="shot_key"):
    return {r[key]: r["p"] for r in frame.select(key, "p").collect()}


def test_walked_nodes_give_the_model_probabilities(spark, split, boosted):
    nodes = N.model_nodes(spark, boosted.model)
    assert nodes.columns == N.NODES
    want = probabilities(score_shots(split[1], boosted.model))
    got = probabilities(N.walked(split[1], nodes, "shot_key"))
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    losses = {r["round"]: r["loss"] for r in N.losses_by_round(split[1], nodes, "shot_key").collect()}
    assert [losses[i] for i in sorted(losses)] == pytest.approx(
        boosted.losses[: boosted.best_round], abs=1e-12
    )


def test_a_pipeline_on_disk_has_the_same_nodes(spark, boosted, rows):
    path = scratch_dir(spark, "pipeline")
    boosted.model.write().save(path)
    assert rows(N.stored_nodes(spark, path)) == rows(N.model_nodes(spark, boosted.model))


def test_coefficients_give_the_logistic_probabilities(spark, split):
    model = M.train_logistic(split[0])
    want = probabilities(score_shots(split[1], model))
    got = probabilities(N.weighed(split[1], N.model_coefficients(spark, model), "shot_key"))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_a_broken_model_turns_the_checks_red(spark, split, boosted):
    nodes = N.model_nodes(spark, boosted.model)
    scored = score_shots(split[1], boosted.model).select("shot_key", "p")

    def green(broken):
        flags = contract.as_walked(scored, split[1], broken).select("as_walked").collect()
        return all(r[0] for r in flags)

    assert green(nodes)
    weight = F.when(F.col("tree") == 1, F.col("weight") * 1.01).otherwise(F.col("weight"))
    assert not green(nodes.withColumn("weight", weight))
    assert not green(nodes.withColumn("threshold", F.col("threshold") + 1))
    assert not green(nodes.where("tree > 0"))


def test_rounds_are_judged_by_the_walk():
    settings = M.Boosting(rounds=8, patience=2)
    told, walked = [0.9, 0.7, 0.8, 0.75], {1: 0.9, 2: 0.7}

    def red(losses, kept):
        return [n for n, right in contract.judged_rounds(losses, kept, settings) if not right]

    assert red(told, walked) == []
    assert red([0.9, 0.71, 0.8, 0.75], walked) == [2]
    assert red([0.9, 0.7, 0.6, 0.75], walked) == [3]
    assert red(told[:3], walked) == [4]
    assert red(told, {1: 0.7, 2: 0.7}) == [1]


def test_learning_is_told_from_not_learning(spark, split, boosted):
    learnt = score_shots(split[0], boosted.model)
    assert contract.has_learnt(learnt)
    assert not contract.has_learnt(learnt.withColumn("p", F.lit(0.5)))
    assert not contract.has_learnt(learnt.withColumn("p", 1 - F.col("p")))


def test_logistic_beats_chance_and_answers_scenarios(spark, split):
    model = M.train_logistic(split[0])
    assert E.eval_auc(score_shots(split[1], model)).first()[0] > 0.6
    p = {r["scenario"]: r["p"] for r in M.what_if_scores(spark, model).collect()}
    assert len(p) == 4
    assert p["3-ft away layup, average player"] > p["25-ft home three, average player"]


def test_one_class_is_refused(split):
    with pytest.raises(ValueError):
        M.train_logistic(split[0].where("label = 1"))


def test_feature_rules(spark):
    """The two rule sets differ only where the raw play has a gap or no rating."""
    plays = bindings.plays(spark, SMALL)
    ratings = rated_players(plays)
    served = feature_rows(plays, ratings, ("play_id",))
    legacy = feature_rows(plays, ratings, ("play_id",), legacy_training=True)
    assert served.columns == legacy.columns == ["play_id", *FEATURES, "label"]
    any_null = " OR ".join(f"{c} IS NULL" for c in FEATURES)
    assert served.where(any_null).count() == 0
    assert legacy.where("period IS NULL").count() > 0
    assert legacy.where("player_skill_rating IS NULL").count() > 0
    assert served.count() == legacy.count()


def test_retrain_publishes_what_it_reports(spark, signal_plays):
    root = scratch_dir(spark, "artifacts")
    done = retrain(spark, signal_plays, root, F.col("play_id"), settings=M.Boosting(rounds=3, depth=3),
                   legacy_training=True)
    assert done.metrics.first()["auc"] > 0.55
    assert {r["split"] for r in done.balance.collect()} == {"train", "test"}
    version, model = load_model(spark, [root])
    assert version.version > 0
    before = [r["p"] for r in done.scenarios.orderBy("scenario").collect()]
    after = [r["p"] for r in M.what_if_scores(spark, model).orderBy("scenario").collect()]
    assert before == after
    _, table = load_ratings(spark, [root])
    assert table.rows == done.ratings.rows == done.ratings.frame.count()
