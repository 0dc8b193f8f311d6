from __future__ import annotations

import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from swishline.operators import evaluation as E


def value(df):
    return df.first()[0]


@pytest.fixture(scope="module")
def scored(spark):
    """Scores with ties, some of them on bucket borders, rising with the label."""
    n = F.col("id")
    noise = F.pmod(F.xxhash64(n), F.lit(1000)) / 1000
    label = F.pmod(F.xxhash64(n, F.lit(1)), F.lit(3)).eqNullSafe(F.lit(0)).cast("int")
    p = F.round(0.7 * noise + 0.2 * label, 3)
    return spark.range(5000).select(p.alias("p"), label.alias("label")).persist()


def brute_auc(pairs):
    pos = [p for p, y in pairs if y == 1]
    neg = [p for p, y in pairs if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def test_auc_matches_brute_force(scored):
    few = scored.limit(800)
    assert value(E.eval_auc(few)) == pytest.approx(brute_auc([tuple(r) for r in few.collect()]))


def test_auc_matches_spark_ml(scored):
    ml = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label", numBins=0)
    want = ml.evaluate(scored.withColumn("label", F.col("label").cast("double")))
    assert value(E.eval_auc(scored)) == pytest.approx(want, abs=1e-9)


def test_auc_ignores_monotone_maps(scored):
    want = value(E.eval_auc(scored))
    bent = scored.withColumn("p", F.col("p") * F.col("p"))
    assert value(E.eval_auc(bent)) == pytest.approx(want)


def test_scores_that_hardly_differ_are_told_apart(spark):
    pairs = [(0.5 + i * 1e-12, i % 2) for i in range(40)]
    frame = spark.createDataFrame(pairs, "p double, label int").repartition(5)
    assert value(E.eval_auc(frame)) == brute_auc(pairs) != 0.5


def test_no_window_of_the_auc_holds_all_scores(spark, scored):
    """The one over everything reads a row per range, after an aggregate by range."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    plan = E.eval_auc(scored)._jdf.queryExecution().explainString(mode)
    over_scores = [line for line in plan.splitlines() if "Window [" in line and "score" in line]
    assert over_scores and all("[range#" in line for line in over_scores)


def test_auc_extremes(spark):
    def auc(pairs):
        return value(E.eval_auc(spark.createDataFrame(pairs, "p double, label int")))

    assert auc([(0.1, 0), (0.9, 1)]) == 1.0
    assert auc([(0.9, 0), (0.1, 1)]) == 0.0
    assert auc([(0.5, 0), (0.5, 1)]) == 0.5
    assert auc([(0.0, 0), (1.0, 1), (1.0, 0)]) == 0.75
    assert auc([(0.5, 1)]) is None


def test_other_metrics_match_brute_force(scored):
    pairs = [tuple(r) for r in scored.collect()]
    clip = [(min(max(p, E.LOG_CLIP), 1 - E.LOG_CLIP), y) for p, y in pairs]
    loss = sum(-math.log(p if y else 1 - p) for p, y in clip) / len(pairs)
    got = E.evaluate(scored).first()
    assert got["n"] == len(pairs)
    assert got["accuracy"] == pytest.approx(sum((p > 0.5) == y for p, y in pairs) / len(pairs))
    assert got["logloss"] == pytest.approx(loss)
    assert got["brier"] == pytest.approx(sum((p - y) ** 2 for p, y in pairs) / len(pairs))
    assert got["auc"] == pytest.approx(value(E.eval_auc(scored)))
    assert value(E.eval_accuracy(scored)) == got["accuracy"]
    assert value(E.eval_logloss(scored)) == pytest.approx(got["logloss"])
    assert value(E.eval_brier(scored)) == pytest.approx(got["brier"])


def test_logloss_of_certain_mistakes_is_finite(spark):
    frame = spark.createDataFrame([(0.0, 1), (1.0, 0)], "p double, label int")
    assert 30 < value(E.eval_logloss(frame)) < 40


def test_class_balance(spark):
    frame = spark.createDataFrame([("train", 1), ("train", 0), ("train", 0), ("test", 1)],
                                  "split string, label int")
    got = {r["split"]: tuple(r)[1:] for r in E.class_balance(frame).collect()}
    assert got["train"] == (3, pytest.approx(1 / 3), pytest.approx(2 / 3), 2.0)
    assert got["test"] == (1, 1.0, 0.0, 0.0)
