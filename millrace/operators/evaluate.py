"""Model evaluation from (label, prediction) rows: single-pass aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.numeric import safe_ratio


def _guarded(num: Column, den: Column) -> Column:
    return F.coalesce(safe_ratio(num, den), F.lit(0.0))


def binary_counts(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.where(F.col(label).isNotNull() & F.col(pred).isNotNull()).groupBy(*by).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
    )


def binary_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall and F1 (0 instead of a division by zero) with
    the number of samples; one row also for an empty table when ungrouped."""
    c = binary_counts(df, label, pred, by)
    tp, tn, fp, fn = (F.col(x).cast("double") for x in ("tp", "tn", "fp", "fn"))
    n = tp + tn + fp + fn
    return c.select(
        *by,
        _guarded(tp + tn, n).alias("accuracy"),
        _guarded(tp, tp + fp).alias("precision"),
        _guarded(tp, tp + fn).alias("recall"),
        _guarded(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        n.cast("bigint").alias("samples_evaluated"),
    )


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """precision, recall, F1 and support per class plus macro and weighted means.

    Works on the confusion cells: each cell adds to its actual and its predicted
    class, so nothing larger than classes squared is ever joined or shuffled.
    """
    cells = confusion(df, label, pred)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").cast("string").alias("class"), F.col("n").alias("support"),
                         F.lit(0).cast("bigint").alias("predicted"),
                         F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("predicted").cast("string").alias("class"), F.lit(0).cast("bigint").alias("support"),
                         F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hit")),
            )
        ).alias("_s")
    ).select("_s.*")
    c = sides.groupBy("class").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                                   F.sum("hit").alias("hit"))
    classes = c.select(
        "class",
        _guarded(F.col("hit").cast("double"), F.col("predicted")).alias("precision"),
        _guarded(F.col("hit").cast("double"), F.col("support")).alias("recall"),
        _guarded(2.0 * F.col("hit"), F.col("predicted") + F.col("support")).alias("f1_score"),
        "support",
    )
    # Each class counts for itself, for the macro and for the weighted row: one grouping, one scan.
    scores = ["precision", "recall", "f1_score"]
    own, macro, weighted = (F.struct(F.lit(k).alias("kind"), name.alias("class")) for k, name in enumerate((F.col("class"), F.lit("macro avg"), F.lit("weighted avg"))))
    rows = classes.withColumn("_to", F.explode(F.array(own, macro, weighted)))

    def value(score: str) -> Column:
        by_support = _guarded(F.sum(F.col(score) * F.col("support")), F.sum("support"))
        return F.when(F.col("_to.kind") == 2, by_support).otherwise(F.avg(score)).alias(score)

    grouped = rows.groupBy("_to").agg(*[value(s) for s in scores], F.sum("support").alias("support"))
    return grouped.select("_to.class", *scores, "support")


def overfit_gap(df: DataFrame, label: str, pred: str, split: str = "split") -> DataFrame:
    """Train accuracy, test accuracy and their difference."""
    right = (F.col(label) == F.col(pred)).cast("double")
    return df.agg(
        F.avg(F.when(F.col(split) == "train", right)).alias("train_accuracy"),
        F.avg(F.when(F.col(split) == "test", right)).alias("test_accuracy"),
    ).withColumn("gap", F.col("train_accuracy") - F.col("test_accuracy"))


def quality_gate(metrics: DataFrame, metric: str = "accuracy", threshold: float = 0.75) -> DataFrame:
    """Adds `passed`; register only rows where it is true."""
    return metrics.withColumn("passed", F.coalesce(F.col(metric) >= threshold, F.lit(False)))


def group_bias(df: DataFrame, group: str, label: str, pred: str) -> DataFrame:
    """Positive rate, true- and false-positive rate per group."""
    c = binary_counts(df, label, pred, [group])
    return c.select(
        group,
        safe_ratio(F.col("tp") + F.col("fp"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("positive_rate"),
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("tpr"),
        safe_ratio(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"),
    )


def bias_gaps(df: DataFrame, group: str, label: str, pred: str) -> DataFrame:
    """Demographic parity and equalised odds: the largest differences between groups."""
    rates = group_bias(df, group, label, pred)

    def spread(c: str) -> Column:
        return F.max(c) - F.min(c)

    return rates.agg(
        spread("positive_rate").alias("demographic_parity_gap"),
        F.greatest(spread("tpr"), spread("fpr")).alias("equalized_odds_gap"),
    )
