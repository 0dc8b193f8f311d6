"""Model quality over scored rows: ``p`` (probability of made) and ``label`` (0/1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from swishline.sources.scratch import written

# probabilities are kept this far from 0 and 1 before taking logarithms
LOG_CLIP = 2.220446049250313e-16


def class_balance(split_rows: DataFrame) -> DataFrame:
    """Per split: rows, made and missed rate, and missed shots per made one."""
    n, made = F.count(F.lit(1)), F.sum("label")
    return split_rows.groupBy("split").agg(
        n.alias("n"),
        (made / n).alias("made_rate"),
        (1 - made / n).alias("missed_rate"),
        F.try_divide(n - made, made).alias("scale_pos_weight"),
    )


def predict_label(scored: DataFrame) -> DataFrame:
    return scored.withColumn("prediction", (F.col("p") > 0.5).cast("int"))


def _accuracy() -> Column:
    correct = (F.col("p") > 0.5).cast("int") == F.col("label")
    return F.avg(correct.cast("double"))


def _logloss() -> Column:
    p = F.greatest(F.least(F.col("p"), F.lit(1 - LOG_CLIP)), F.lit(LOG_CLIP))
    return F.avg(-F.when(F.col("label") == 1, F.ln(p)).otherwise(F.ln(1 - p)))


def _brier() -> Column:
    error = F.col("p") - F.col("label")
    return F.avg(error * error)


def eval_accuracy(scored: DataFrame) -> DataFrame:
    return scored.agg(_accuracy().alias("accuracy"))


def eval_logloss(scored: DataFrame) -> DataFrame:
    return scored.agg(_logloss().alias("logloss"))


def eval_brier(scored: DataFrame) -> DataFrame:
    return scored.agg(_brier().alias("brier"))


def eval_auc(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve, exact: scores are compared as they are, ties count half.

    Each positive counts the negatives that score lower: a running total over all
    scores, which one ordered window would take in a single task. Instead rows collapse
    to one count per score before they shuffle, the scores are dealt to tasks by ranges,
    and totals run within the ranges; a row per range then says how many negatives lie
    below it. The ranges are stored, since both steps must see the same ones.
    """
    per_score = scored.groupBy(F.col("p").alias("score")).agg(
        F.sum("label").cast("double").alias("pos"),
        F.sum(1 - F.col("label")).cast("double").alias("neg"),
    )
    ranges = per_score.repartitionByRange("score").withColumn("range", F.spark_partition_id())
    lower_scores = _before(Window.partitionBy("range").orderBy("score"))
    per_range = (
        written(ranges, "auc_scores")
        .withColumn("below", lower_scores)
        .groupBy("range")
        .agg(
            F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("wins"),
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
        )
    )
    # as many rows as there are tasks
    lower_ranges = _before(Window.partitionBy(F.lit(0)).orderBy("range"))
    ranked = per_range.withColumn("below", lower_ranges)
    wins = F.sum(F.col("wins") + F.col("pos") * F.col("below"))
    return ranked.agg(F.try_divide(wins, F.sum("pos") * F.sum("neg")).alias("auc"))


def _before(order: WindowSpec) -> Column:
    """Negatives in the rows before this one."""
    rows = order.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("neg").over(rows), F.lit(0.0))


def evaluate(scored: DataFrame) -> DataFrame:
    """All four metrics in one row."""
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        _accuracy().alias("accuracy"),
        _logloss().alias("logloss"),
        _brier().alias("brier"),
    ).withColumn("auc", eval_auc(scored).scalar())
