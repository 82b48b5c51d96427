"""Profiles and aggregates: every one is a single pass with map-side combine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.ordered import exact_quantiles


def long_form(df: DataFrame, cols: Sequence[str], kind: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value) rows: one narrow pass, no job per column."""
    typed = df.select(*keep, *[F.col(c).cast(kind).alias(c) for c in cols])
    return typed.unpivot(list(keep), list(cols), "feature", "value")


def moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), std: str = "population") -> DataFrame:
    """count, mean, std, min and max per feature (and per group)."""
    spread = F.stddev_pop if std == "population" else F.stddev_samp
    return (
        long_form(df, cols, keep=by)
        .groupBy(*by, "feature")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            spread("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )


def describe(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max per feature, rounded."""
    quartiles = exact_quantiles(
        long_form(df, cols), ["feature"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    )
    joined = moments(df, cols, std="sample").join(quartiles, "feature")
    shown = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return joined.select("feature", "count", *[F.round(c, digits).alias(c) for c in shown])


def medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated median per feature (and per group)."""
    return exact_quantiles(long_form(df, cols, keep=by), [*by, "feature"], "value", {"median": 0.5})


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-NULL value per column, the smallest one on a tie."""
    counts = (
        long_form(df, cols, kind="string")
        .where("value IS NOT NULL")
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The least (-n, value) is the largest count with the smallest value.
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("_b"))
    return best.select("feature", F.col("_b.value").alias("mode"), (-F.col("_b.m")).alias("n"))


def value_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def with_share(counts: DataFrame, n: str = "n", within: Sequence[str] = ()) -> DataFrame:
    """Adds `share_pct`, the percentage of the total (per `within` group)."""
    totals = counts.groupBy(*within).agg(F.sum(n).alias("_total"))
    if within:
        joined = counts.join(totals, list(within))
        return joined.withColumn("share_pct", F.try_divide(F.col(n) * 100.0, F.col("_total"))).drop("_total")
    return counts.withColumn("share_pct", F.try_divide(F.col(n) * 100.0, totals.scalar()))


def rate(condition: Column) -> Column:
    """Share of rows with a true condition, unknown ones left out."""
    return F.avg(condition.cast("double"))


def top_k(counts: DataFrame, k: int, n: str = "n", tie: Sequence[str] = ()) -> DataFrame:
    """The k largest counts, ties in key order: planned as a per-task top-k."""
    return counts.orderBy(F.col(n).desc(), *tie).limit(k)


def extreme_rows(df: DataFrame, score: str, row_id: str, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows with the greatest and the smallest score, lowest id on a tie; ids of any
    type that has an order. Rows without a score are neither."""
    row, order = F.struct(row_id, score, *cols), extreme_order
    return df.groupBy(*by).agg(
        F.min_by(row, order(-F.col(score), F.col(row_id))).alias("highest"),
        F.min_by(row, order(F.col(score), F.col(row_id))).alias("lowest"),
    )


def extreme_order(score: Column, row_id: Column) -> Column:
    """Order for `min_by`: by score, then id; rows without a score are passed over."""
    return F.when(score.isNotNull(), F.struct(score, row_id))


def two_level_mean(df: DataFrame, by: Sequence[str], period: Column, value: str) -> DataFrame:
    """Mean of per-period means (each period counts once) beside the plain mean."""
    periods = (
        df.withColumn("_period", period)
        .groupBy(*by, "_period")
        .agg(F.avg(value).alias("_m"), F.sum(value).alias("_s"), F.count(value).alias("_n"),
             F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    )
    return periods.groupBy(*by).agg(
        F.avg("_m").alias("mean_of_periods"),
        F.try_divide(F.sum("_s"), F.sum("_n")).alias("weighted_mean"),
        F.min("_lo").alias("min"),
        F.max("_hi").alias("max"),
        F.count(F.lit(1)).alias("periods"),
    )


def conditional_means(df: DataFrame, by: str, values: Sequence, measures: Mapping[str, Column]) -> DataFrame:
    """One row: the mean of every measure for every listed group, side by side."""
    return df.agg(
        *[
            F.avg(F.when(F.col(by) == F.lit(v), m)).alias(f"{name}_{v}")
            for v in values
            for name, m in measures.items()
        ]
    )
