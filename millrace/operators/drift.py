"""Baselines, drift measures and monitoring reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.numeric import change_pct
from millrace.operators import quality, stats
from millrace.operators.ordered import GROUP_ROWS, exact_quantiles, ks_distance


def baseline_statistics(df: DataFrame, cols: Sequence[str], std: str = "population") -> DataFrame:
    """(feature, count, mean, std, min, max); the std kind is a parameter."""
    return stats.moments(df, cols, std=std)


def baseline_constraints(df: DataFrame, kinds: Mapping[str, str], comparison: str = "Robust",
                         threshold: float = 0.1) -> DataFrame:
    """Declared type, completeness, type conformance and the distribution rule per feature."""
    kind = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    return quality.conformance(df, kinds).select(
        F.col("column_name").alias("feature"),
        kind[F.col("column_name")].alias("declared_type"),
        "completeness",
        "type_conformance",
        F.lit(comparison).alias("comparison_type"),
        F.lit(threshold).alias("threshold"),
    )


def mean_shift(baseline: DataFrame, current: DataFrame, threshold: float = 20.0) -> DataFrame:
    """Change of the mean per feature in percent; `DRIFT` when it exceeds the
    threshold strictly, `N/A` when the baseline mean is zero or missing.
    Features of either side are kept."""
    b = baseline.select("feature", F.col("mean").alias("baseline"))
    c = current.select("feature", F.col("mean").alias("current"))
    pct = change_pct(F.col("baseline"), F.col("current"))
    status = F.when(pct.isNull(), "N/A").when(F.abs(pct) > threshold, "DRIFT").otherwise("OK")
    return b.join(c, "feature", "full_outer").withColumn("change_pct", pct).withColumn("status", status)


def mean_shift_of_segments(df: DataFrame, cols: Sequence[str], is_current: Column, threshold: float = 20.0) -> DataFrame:
    """The same from one pass over rows of both segments."""
    tagged = df.withColumn("_cur", is_current)
    long = stats.long_form(tagged, cols, keep=["_cur"])
    means = long.groupBy("feature").agg(
        F.avg(F.when(~F.col("_cur"), F.col("value"))).alias("baseline"),
        F.avg(F.when(F.col("_cur"), F.col("value"))).alias("current"),
    )
    pct = change_pct(F.col("baseline"), F.col("current"))
    status = F.when(pct.isNull(), "N/A").when(F.abs(pct) > threshold, "DRIFT").otherwise("OK")
    return means.withColumn("change_pct", pct).withColumn("status", status)


def stability_index(df: DataFrame, cols: Sequence[str], is_current: Column, bins: int = 10,
                    epsilon: float = 1e-4, limit: int = GROUP_ROWS) -> DataFrame:
    """Population Stability Index per feature over bins cut at the baseline's
    exact quantiles; an empty bin counts as a share of epsilon.

    The cuts are fitted first (a few numbers per feature column reach the driver),
    then one pass bins both segments with plain comparisons.
    """
    tagged = df.withColumn("_cur", is_current)
    baseline = stats.long_form(tagged.where(~F.col("_cur")), cols)
    names = {f"q{i}": i / bins for i in range(1, bins)}
    cuts = {r.feature: [r[q] for q in names] for r in exact_quantiles(baseline, ["feature"], "value", names, limit=limit).collect()}

    def bin_of(c: str) -> Column:
        value = F.col(c).cast("double")
        above = [(F.lit(e) < value).cast("int") for e in cuts.get(c, [])]
        return F.when(value.isNotNull(), reduce(add, above, F.lit(0))).alias(c)

    placed = tagged.select("_cur", *[bin_of(c) for c in cols]).unpivot("_cur", list(cols), "feature", "bin")
    counts = placed.where("bin IS NOT NULL").groupBy("feature").agg(
        F.count_if(~F.col("_cur")).alias("nb"),
        F.count_if(F.col("_cur")).alias("nc"),
        *[F.count_if(~F.col("_cur") & (F.col("bin") == i)).alias(f"b{i}") for i in range(bins)],
        *[F.count_if(F.col("_cur") & (F.col("bin") == i)).alias(f"c{i}") for i in range(bins)],
    )

    def share(n: str, total: str) -> Column:
        return F.greatest(F.coalesce(F.try_divide(F.col(n), F.col(total)), F.lit(0.0)), F.lit(epsilon))

    parts = [(share(f"c{i}", "nc"), share(f"b{i}", "nb")) for i in range(bins)]
    return counts.select("feature", reduce(add, [(c - b) * F.ln(c / b) for c, b in parts]).alias("psi"))


def ks_shift(df: DataFrame, cols: Sequence[str], is_current: Column, limit: int = GROUP_ROWS) -> DataFrame:
    """Two-sample KS distance per feature."""
    long = stats.long_form(df.withColumn("_cur", is_current), cols, keep=["_cur"])
    return ks_distance(long, ["feature"], "value", F.col("_cur"), limit=limit)


def prediction_drift(df: DataFrame, segment: str, score: str, normal: str, drifted: str, cut: float = 0.5) -> DataFrame:
    """Mean prediction and positive rate of both segments and their change in percent."""
    approved = (F.col(score) > cut).cast("double")

    def of(name: str, value: Column) -> Column:
        return F.avg(F.when(F.col(segment) == name, value))

    one = df.agg(
        of(normal, F.col(score)).alias("mean_normal"),
        of(drifted, F.col(score)).alias("mean_drifted"),
        of(normal, approved).alias("rate_normal"),
        of(drifted, approved).alias("rate_drifted"),
    )
    return one.withColumns(
        {
            "mean_change_pct": change_pct(F.col("mean_normal"), F.col("mean_drifted")),
            "rate_change_pct": change_pct(F.col("rate_normal"), F.col("rate_drifted")),
        }
    )


def violation_report(*, shift: DataFrame | None = None, psi: DataFrame | None = None, ks: DataFrame | None = None,
                     conformance: DataFrame | None = None, psi_limit: float = 0.2, ks_limit: float = 0.1,
                     completeness_limit: float = 1.0) -> DataFrame:
    """(feature, check_name, baseline, current, severity) of all checks, in one schema. A measure
    that is NULL, as when no rows came in, is `unknown`."""
    null = F.lit(None).cast("double")
    parts = []
    if shift is not None:
        level = F.when(F.col("status") == "DRIFT", "alert").when(F.col("status") == "N/A", "unknown").otherwise("ok")
        parts.append(shift.select("feature", F.lit("mean_shift").alias("check_name"), "baseline", "current", level.alias("severity")))
    if psi is not None:
        level = F.when(F.col("psi") > psi_limit, "alert").when(F.col("psi").isNull(), "unknown").otherwise("ok")
        parts.append(psi.select("feature", F.lit("psi").alias("check_name"), F.lit(psi_limit).alias("baseline"), F.col("psi").alias("current"), level.alias("severity")))
    if ks is not None:
        level = F.when(F.col("ks") > ks_limit, "alert").when(F.col("ks").isNull(), "unknown").otherwise("ok")
        parts.append(ks.select("feature", F.lit("ks").alias("check_name"), F.lit(ks_limit).alias("baseline"), F.col("ks").alias("current"), level.alias("severity")))
    if conformance is not None:
        level = F.when(F.col("completeness") < completeness_limit, "alert").when(F.col("completeness").isNull(), "unknown").otherwise("ok")
        parts.append(conformance.select(F.col("column_name").alias("feature"), F.lit("completeness").alias("check_name"), F.lit(completeness_limit).alias("baseline"), F.coalesce("completeness", null).alias("current"), level.alias("severity")))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def retrain_decision(report: DataFrame, min_features: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """Retrain when at least `min_features` features raised an alert."""
    flagged = report.groupBy(*by, "feature").agg(F.max((F.col("severity") == "alert").cast("int")).alias("_hit"))
    return flagged.groupBy(*by).agg(F.sum("_hit").cast("bigint").alias("drifted_features")).withColumn(
        "retrain", F.col("drifted_features") >= min_features
    )


def quality_by_period(df: DataFrame, period: Column, value: str, raw: str, kind: str, baseline_mean: Column,
                      threshold: float = 20.0) -> DataFrame:
    """Per period: rows, missing values, type failures and mean shift of a feature. The alert is
    NULL where the change is unknown."""
    grouped = df.groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(value).isNull()).alias("missing"),
        F.count_if(F.col(raw).isNotNull() & F.col(raw).try_cast(kind).isNull()).alias("type_failures"),
        F.avg(value).alias("mean"),
    )
    pct = change_pct(baseline_mean, F.col("mean"))
    return grouped.withColumn("change_pct", pct).withColumn("alert", F.abs(pct) > threshold)


def capture_counts(df: DataFrame, period: Column) -> DataFrame:
    """Captured rows per period."""
    return df.groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("captured"))


def rank_changes(importance: DataFrame, segment: str, before: str, after: str) -> DataFrame:
    """Rank of every feature's importance in two segments and the move between
    them. Ranks a table of one row per feature and segment."""
    from pyspark.sql import Window as W

    ranked = importance.withColumn(
        "rank", F.row_number().over(W.partitionBy(segment).orderBy(F.col("importance").desc(), "feature"))
    )
    sides = ranked.groupBy("feature").agg(
        F.max(F.when(F.col(segment) == before, F.col("rank"))).alias("rank_before"),
        F.max(F.when(F.col(segment) == after, F.col("rank"))).alias("rank_after"),
    )
    return sides.withColumn("move", F.col("rank_before") - F.col("rank_after"))
