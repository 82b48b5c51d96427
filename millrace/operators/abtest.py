"""Variant assignment, traffic and latency reports over a call log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.numeric import hash_bucket, safe_ratio
from millrace.operators import stats
from millrace.operators.ordered import after_first, exact_quantiles

Weights = Sequence[tuple[str, float]]

_BUCKETS = 10_000


def _pick(bucket: Column, weights: Weights) -> Column:
    total = sum(w for _, w in weights)
    edge, expr = 0.0, None
    for name, weight in weights:
        edge += weight / total * _BUCKETS
        hit = bucket < F.lit(round(edge))
        expr = F.when(hit, name) if expr is None else expr.when(hit, name)
    return expr


def assign_variant(key: Column, weights: Weights, seed: str = "ab") -> Column:
    """Sticky weighted variant: one key always gets the same one."""
    return _pick(hash_bucket(key, _BUCKETS, seed), weights)


def assign_with_override(target: Column, key: Column, weights: Weights, seed: str = "ab") -> Column:
    """The requested variant where a call names one, else the assigned one."""
    return F.coalesce(target, assign_variant(key, weights, seed))


def assign_staged(ts: Column, key: Column, stages: Sequence[tuple[str, Weights]], seed: str = "ab") -> Column:
    """Weights that change over time: `stages` lists (valid-from, weights) in time
    order. The schedule is a parameter, so no join is needed. A key only ever
    moves towards the variant whose share grows."""
    bucket = hash_bucket(key, _BUCKETS, seed)
    expr = None
    for start, weights in reversed(stages):
        hit = ts >= F.lit(start).cast("timestamp")
        picked = _pick(bucket, weights)
        expr = F.when(hit, picked) if expr is None else expr.when(hit, picked)
    return expr


def distribution(df: DataFrame, variant: str = "variant") -> DataFrame:
    return stats.with_share(stats.value_counts(df, [variant]))


def split_check(df: DataFrame, weights: Weights, tolerance: float = 10.0, variant: str = "variant") -> DataFrame:
    """Observed against expected share, within +-tolerance points (inclusive)."""
    total = sum(w for _, w in weights)
    expected = F.create_map(*[F.lit(x) for n, w in weights for x in (n, 100.0 * w / total)])
    return distribution(df, variant).withColumn("expected_pct", F.try_element_at(expected, F.col(variant))).withColumn(
        "within", F.col("share_pct").between(F.col("expected_pct") - tolerance, F.col("expected_pct") + tolerance)
    )


def latency_by_period(df: DataFrame, by: Sequence[str], period: Column, latency: str) -> DataFrame:
    """avg, min, max and calls per group and period."""
    return df.groupBy(*by, period.alias("period")).agg(
        F.avg(latency).alias("avg_latency"),
        F.min(latency).alias("min_latency"),
        F.max(latency).alias("max_latency"),
        F.count(F.lit(1)).alias("n"),
    )


def latency_summary(df: DataFrame, by: Sequence[str], latency: str) -> DataFrame:
    """avg with positional p50 and p95 (element floor(n*p) of the sorted calls)."""
    means = df.groupBy(*by).agg(F.avg(latency).alias("avg"), F.count(latency).alias("n"))
    tails = exact_quantiles(df, by, latency, {"p50": 0.5, "p95": 0.95}, kind="positional")
    return means.join(tails, list(by))


def warm_calls(df: DataFrame, by: Sequence[str], order: Sequence[str], skip: int) -> DataFrame:
    """Calls after the first `skip` per group."""
    return after_first(df, by, order, skip)


def speedup(baseline: Column, candidate: Column) -> tuple[Column, Column]:
    """(ratio, verdict): how many times faster the candidate is."""
    ratio = safe_ratio(baseline, candidate)
    verdict = F.when(ratio > 1, "faster").when(ratio < 1, "slower").when(ratio == 1, "equal")
    return ratio, verdict


def head_to_head(df: DataFrame, variant: str, a: str, b: str, metrics: dict[str, tuple[Column, str]]) -> DataFrame:
    """One row per metric: both values and the winner. A metric is (aggregate over
    a filtered group, 'low' or 'high' wins)."""
    per_variant = df.where(F.col(variant).isin(a, b)).groupBy(variant).agg(
        *[expr.alias(name) for name, (expr, _) in metrics.items()]
    )
    rows = stats.long_form(per_variant, list(metrics), keep=[variant])
    # Two variants by a handful of metrics: this pivot groups an aggregate.
    table = rows.groupBy(F.col("feature").alias("metric")).agg(
        F.max(F.when(F.col(variant) == a, F.col("value"))).alias("value_a"),
        F.max(F.when(F.col(variant) == b, F.col("value"))).alias("value_b"),
    )
    low = [n for n, (_, better) in metrics.items() if better == "low"]
    a_wins = F.when(F.col("metric").isin(low), F.col("value_a") < F.col("value_b")).otherwise(
        F.col("value_a") > F.col("value_b")
    )
    tie = F.col("value_a") == F.col("value_b")
    known = F.col("value_a").isNotNull() & F.col("value_b").isNotNull()
    return table.withColumn("winner", F.when(tie, "tie").when(a_wins, a).when(known, b))


def promotion(df: DataFrame, variant: str, correct: Column, champion: str, challenger: str, margin: float = 0.02) -> DataFrame:
    """Accuracy of both and whether the challenger wins by more than the margin."""
    return df.agg(
        F.avg(F.when(F.col(variant) == champion, correct.cast("double"))).alias("champion"),
        F.avg(F.when(F.col(variant) == challenger, correct.cast("double"))).alias("challenger"),
    ).withColumn("promote", F.col("challenger") > F.col("champion") + margin)


def size_change(before: Column, after: Column) -> tuple[Column, Column]:
    """(percent, kind): reduction or increase between two artefact sizes; no
    result when a size is missing."""
    pct = safe_ratio((before - after) * 100.0, before)
    kind = F.when(pct > 0, "reduction").when(pct < 0, "increase").when(pct == 0, "none")
    return F.abs(pct), kind
