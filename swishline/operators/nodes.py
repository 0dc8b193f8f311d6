"""Fitted models as tables, and probabilities by walking them with joins.

A boosted model is a table of nodes: which feature a node compares with which
threshold, its children, and what a leaf adds. A logistic model is a table of
coefficients. Both say without the library that fitted them what a shot's probability
is, so a scorer can be checked against them, and reports can read a model with SQL.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swishline.schemas import FEATURES
from swishline.sources import files
from swishline.sources.scratch import scratch_dir, written

LEAF = -1
NODES = ["tree", "node", "weight", "feature", "threshold", "below", "above", "value"]


def model_nodes(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The nodes of a boosted model, from 0 in each tree: NODES.

    Rows whose ``feature`` (a place in FEATURES) is at most ``threshold`` go to the node
    ``below``, others to ``above``; a leaf (feature LEAF) adds weight * value. Read from
    the form in which the model is stored.
    """
    path = scratch_dir(spark, "model")
    model.stages[-1].write().save(path)
    return stored_nodes(spark, path)


def stored_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The same of a boosted model stored at ``path``, or of a pipeline that ends in one."""
    if files.is_there(spark, f"{path}/stages"):
        stages = files.folders(spark, f"{path}/stages")
        path = f"{path}/stages/{max(stages, key=lambda n: int(n.split('_')[0]))}"
    weights = spark.read.parquet(f"{path}/treesMetadata").select(
        F.col("_1").alias("tree"), F.col("_3").alias("weight")
    )
    split = F.col("nodeData.split")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        split["featureIndex"].alias("feature"),
        F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.col("nodeData.leftChild").alias("below"),
        F.col("nodeData.rightChild").alias("above"),
        F.col("nodeData.prediction").alias("value"),
    )
    # a row per tree: as many as rounds
    return nodes.join(F.broadcast(weights), "tree").select(*NODES)


def leaves_reached(rows: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """key, tree, weight and value of the leaf that each row reaches in each tree.

    ``nodes`` is small (rounds times nodes of a tree) and sent to all tasks; a level of
    the trees is one look-up, and nothing is shuffled. A missing input goes above.
    """
    nodes = written(nodes, "nodes")
    shape = nodes.agg(F.max("tree").alias("trees"), F.max("node").alias("nodes")).first()
    depth = _depth(nodes)
    inputs = F.array(*[F.col(name).cast("double") for name in FEATURES])
    at = rows.select(
        F.col(key),
        inputs.alias("inputs"),
        F.explode(F.sequence(F.lit(0), F.lit(shape["trees"]))).alias("tree"),
        F.lit(0).alias("node"),
    )
    small = F.broadcast(nodes)
    for _ in range(depth):
        goes_below = F.get("inputs", F.col("feature")) <= F.col("threshold")
        child = F.when(goes_below, F.col("below")).otherwise(F.col("above"))
        moved = F.when(F.col("feature") == LEAF, F.col("node")).otherwise(child)
        at = at.join(small, ["tree", "node"]).select(key, "inputs", "tree", moved.alias("node"))
    return at.join(small, ["tree", "node"]).select(key, "tree", "weight", "value")


def _depth(nodes: DataFrame) -> int:
    """Levels below the root, found by following the children."""
    depth, at = 0, nodes.where("node = 0")
    while at.where(F.col("feature") != LEAF).limit(1).count():
        children = at.where(F.col("feature") != LEAF).select(
            "tree", F.explode(F.array("below", "above")).alias("node")
        )
        at = written(children.join(nodes, ["tree", "node"]), "level")
        depth += 1
    return depth


def probability(margin: Column) -> Column:
    """Of a boosted margin, whose loss is log(1 + exp(-2 * margin))."""
    return 1 / (1 + F.exp(-2 * margin))


def walked(rows: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """key and ``p`` of every row of distinct ``key``, from the leaves it reaches."""
    reached = leaves_reached(rows, nodes, key)
    margin = F.sum(F.col("weight") * F.col("value"))
    return reached.groupBy(key).agg(probability(margin).alias("p"))


def losses_by_round(rows: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """round (from 1) and ``loss``: the mean log loss of the first trees over ``rows``.

    Margins add up tree by tree within a row; a row has as many as rounds.
    """
    reached = leaves_reached(rows.select(key, "label", *FEATURES), nodes, key)
    own = reached.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("tree", "weight", "value"))).alias("leaves")
    )
    so_far = F.transform(
        F.sequence(F.lit(1), F.size("leaves")),
        lambda n: F.aggregate(
            F.slice("leaves", F.lit(1), n),
            F.lit(0.0),
            lambda total, leaf: total + leaf["weight"] * leaf["value"],
        ),
    )
    labelled = own.join(rows.select(key, "label"), key)
    sign = 2 * F.col("label") - 1
    margins = labelled.select(sign.alias("sign"), F.posexplode(so_far).alias("pos", "margin"))
    loss = 2 * F.log1p(F.exp(-2 * F.col("sign") * F.col("margin")))
    return margins.groupBy((F.col("pos") + 1).alias("round")).agg(F.avg(loss).alias("loss"))


def model_coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """feature and coefficient of a logistic model; the intercept has a null feature."""
    fitted = model.stages[-1]
    rows = [(n, float(c)) for n, c in zip(FEATURES, fitted.coefficients.toArray(), strict=True)]
    rows.append((None, float(fitted.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def weighed(rows: DataFrame, coefficients: DataFrame, key: str) -> DataFrame:
    """key and ``p`` of every row of distinct ``key`` by a logistic model's coefficients."""
    inputs = rows.select(key, *[F.col(f).cast("double").alias(f) for f in FEATURES])
    terms = inputs.unpivot([key], FEATURES, "feature", "input")
    # 15 rows
    own = F.broadcast(coefficients.where("feature IS NOT NULL"))
    sums = terms.join(own, "feature").groupBy(key).agg(
        F.sum(F.col("input") * F.col("coefficient")).alias("score")
    )
    intercept = coefficients.where("feature IS NULL").select("coefficient").scalar()
    return sums.select(key, (1 / (1 + F.exp(-(F.col("score") + intercept)))).alias("p"))
