"""Make-probability models on Spark ML."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swishline.operators.scoring import score_shots
from swishline.schemas import FEATURES
from swishline.sources.scratch import use_checkpoints

log = logging.getLogger(__name__)

# ---------------------------------------------------------------- fixed values
# four shots to try a model on: name, then the features in model order
SCENARIOS = [
    ("3-ft home dunk, elite player", 3, 2, 300, 0, 1, 0, 0, 0, 0, 0, 0, 1, 0, 0.55),
    ("3-ft away layup, average player", 3, 2, 300, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0.45),
    ("25-ft home three, average player", 25, 2, 300, 1, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0.45),
    ("25-ft away pullup at the buzzer", 25, 4, 2, 1, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0.45),
]


@dataclass(frozen=True)
class Boosting:
    """Boosted-tree settings."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.1
    row_share: float = 0.8
    column_share: float = 0.8
    patience: int = 10
    seed: int = 42


@dataclass(frozen=True)
class Boosted:
    """A fitted model, the held-out loss after each round fitted, and the round it kept."""

    model: PipelineModel
    losses: list[float]
    best_round: int


def positive_weight(train: DataFrame) -> float:
    """Missed shots per made one, so that both classes weigh the same."""
    counts = train.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("made")).first()
    if not counts["made"] or counts["made"] == counts["n"]:
        raise ValueError("training needs both made and missed shots")
    return (counts["n"] - counts["made"]) / counts["made"]


def _prepared(train: DataFrame, impute: bool) -> list[Transformer]:
    """Fitted stages in front of the classifier."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    if not impute:
        return [assembler]
    # Spark's trees have no branch for missing values
    imputer = Imputer(inputCols=FEATURES, outputCols=FEATURES, strategy="mean")
    return [imputer.fit(train), assembler]


def _weighted(rows: DataFrame, stages: list[Transformer], weight: float) -> DataFrame:
    """Only what fitting reads: vector, label and weight."""
    rows = PipelineModel(stages).transform(rows)
    return rows.select(
        "features",
        F.col("label").cast("double").alias("label"),
        F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(1.0).alias("weight"),
    )


def best_round(losses: list[float], patience: int) -> int:
    """Rounds to keep (from 1): the best one before ``patience`` rounds in a row
    brought no gain."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def stops(rounds: int, patience: int) -> list[int]:
    """Rounds of the fits to try one after the other: halves of ``rounds``, least first, as
    long as patience can run out in them."""
    found = [rounds]
    while found[0] // 2 > patience:
        found.insert(0, found[0] // 2)
    return found


def train_boosted(
    train: DataFrame, valid: DataFrame, settings: Boosting = Boosting(), impute: bool = False
) -> Boosted:
    """Boosted trees, cut at the round that did best on ``valid``.

    Fits grow in stages, each of about twice the rounds of the last, until patience has
    run out: with one seed the first trees are the same however many follow, so a
    model whose best round is early never pays for the rounds after it. If the first stage
    ends with its lowest loss, the next one has all rounds, and so has the third in any case.
    ``losses`` are those of the last fit. Pass stored tables: every round reads the rows
    again where memory is short. The cut model is made of the first trees of the fitted one.
    """
    use_checkpoints(train.sparkSession)
    stages = _prepared(train, impute)
    rows = _weighted(train, stages, positive_weight(train))
    held_out = _weighted(valid, stages, 1.0)
    learner = GBTClassifier(
        maxDepth=settings.depth,
        stepSize=settings.rate,
        subsamplingRate=settings.row_share,
        featureSubsetStrategy=str(settings.column_share),
        weightCol="weight",
        seed=settings.seed,
    )
    first, *later = stops(settings.rounds, settings.patience)
    rounds = first
    while True:
        fitted = learner.copy({learner.maxIter: rounds}).fit(rows)
        losses = list(fitted.evaluateEachIteration(held_out))
        keep = best_round(losses, settings.patience)
        if rounds == settings.rounds or len(losses) - keep >= settings.patience:
            break
        rounds = later[0] if rounds == first and keep < rounds else settings.rounds
    if keep < len(losses):
        fitted = shortened(fitted, keep)
    return Boosted(PipelineModel([*stages, fitted]), losses, keep)


def shortened(fitted: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` trees: boosting never changes earlier ones."""
    gateway = SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml
    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i] = fitted._java_obj.trees()[i]
        weights[i] = fitted.treeWeights[i]
    cut = ml.classification.GBTClassificationModel(
        fitted.uid, trees, weights, fitted.numFeatures, fitted.numClasses
    )
    return fitted._copyValues(GBTClassificationModel(cut))


def train_logistic(
    train: DataFrame, impute: bool = False, max_iter: int = 200, tolerance: float = 1e-8
) -> PipelineModel:
    """The linear alternative, with the same inputs and class weights.

    It stops when an iteration changes the loss by less than ``tolerance``, relatively.
    A fit that ``max_iter`` iterations end before that is used, with a warning.
    """
    stages = _prepared(train, impute)
    rows = _weighted(train, stages, positive_weight(train))
    fitted = LogisticRegression(weightCol="weight", maxIter=max_iter, tol=tolerance).fit(rows)
    if fitted.summary.totalIterations >= max_iter:
        log.warning("the logistic model has not converged in %d iterations", max_iter)
    return PipelineModel([*stages, fitted])


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Weight of each of the 14 inputs, largest first."""
    fitted = model.stages[-1]
    if hasattr(fitted, "featureImportances"):
        weights = fitted.featureImportances.toArray()
    else:
        weights = fitted.coefficients.toArray()
    rows = [(name, float(weight)) for name, weight in zip(FEATURES, weights, strict=True)]
    frame = spark.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.col("importance").desc(), "feature")


def scenario_rows(spark: SparkSession) -> DataFrame:
    rows = [(name, *map(float, values)) for name, *values in SCENARIOS]
    schema = "scenario string, " + ", ".join(f"{name} double" for name in FEATURES)
    return spark.createDataFrame(rows, schema)


def what_if_scores(spark: SparkSession, model: PipelineModel) -> DataFrame:
    return score_shots(scenario_rows(spark), model).select("scenario", "p")
