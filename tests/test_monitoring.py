"""Drift, evaluation, A/B and latency."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import abtest, drift, evaluate, quality


def test_mean_shift_of_loan_features(spark):
    base = spark.createDataFrame(
        [("age", 35.0), ("income", 50000.0), ("credit_score", 700.0), ("loan_amount", 25000.0), ("employment_years", 8.0), ("zero", 0.0), ("gone", 1.0), ("edge", 100.0)],
        "feature string, mean double",
    )
    now = spark.createDataFrame(
        [("age", 45.0), ("income", 35000.0), ("credit_score", 620.0), ("loan_amount", 40000.0), ("employment_years", 3.0), ("zero", 5.0), ("new", 1.0), ("edge", 120.0)],
        "feature string, mean double",
    )
    got = {r.feature: (r.change_pct and round(r.change_pct, 2), r.status) for r in drift.mean_shift(base, now).collect()}
    assert got == {
        "age": (28.57, "DRIFT"), "income": (-30.0, "DRIFT"), "credit_score": (-11.43, "OK"), "loan_amount": (60.0, "DRIFT"),
        "employment_years": (-62.5, "DRIFT"), "zero": (None, "N/A"), "gone": (None, "N/A"), "new": (None, "N/A"), "edge": (20.0, "OK"),
    }


@pytest.mark.parametrize("limit", [1_000_000, 40])
def test_stability_index(spark, limit):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 400).round(2), rng.normal(0.4, 1.2, 300).round(2)
    df = spark.createDataFrame([(float(x), False) for x in a] + [(float(x), True) for x in b], "x double, cur boolean")
    got = drift.stability_index(df, ["x"], F.col("cur"), limit=limit).first().psi
    edges = np.quantile(a, [i / 10 for i in range(1, 10)])
    place = lambda v: np.bincount([int((edges < x).sum()) for x in v], minlength=10)
    p, q = np.maximum(place(a) / len(a), 1e-4), np.maximum(place(b) / len(b), 1e-4)
    assert got == pytest.approx(float(((q - p) * np.log(q / p)).sum()), abs=1e-9)
    same = df.where("NOT cur").unionByName(df.where("NOT cur").withColumn("cur", F.lit(True)))
    assert drift.stability_index(same, ["x"], F.col("cur"), limit=limit).first().psi == pytest.approx(0.0, abs=1e-12)
    assert drift.ks_shift(same, ["x"], F.col("cur"), limit=limit).first().ks == 0.0


def test_report_and_retraining(spark):
    df = spark.createDataFrame([(1.0, 5.0, False), (1.0, 5.0, False), (2.0, 5.0, True), (None, 5.0, True)], "a double, b double, cur boolean")
    report = drift.violation_report(
        shift=drift.mean_shift_of_segments(df, ["a", "b"], F.col("cur")), ks=drift.ks_shift(df, ["a", "b"], F.col("cur")),
        conformance=quality.conformance(df, {"a": "double", "b": "double"}),
    )
    assert {(r.feature, r.check_name) for r in report.where("severity = 'alert'").collect()} == {("a", "mean_shift"), ("a", "ks"), ("a", "completeness")}
    assert drift.retrain_decision(report).first().retrain is True
    assert drift.retrain_decision(report, min_features=2).first().retrain is False


def test_prediction_drift(spark):
    df = spark.createDataFrame([("n", 0.9), ("n", 0.4), ("d", 0.2), ("d", 0.45)], "seg string, p double")
    r = drift.prediction_drift(df, "seg", "p", "n", "d").first()
    assert (r.rate_normal, r.rate_drifted, r.rate_change_pct) == (0.5, 0.0, -100.0)


CASES = [
    ([(1, 0.9), (0, 0.5), (1, 0.4), (0, 0.6)], (0.5, 0.5, 0.5, 0.5, 4)),
    ([(1, 0.1), (1, 0.2)], (0.0, 0.0, 0.0, 0.0, 2)),  # no positive predicted
    ([(0, 0.9), (0, 0.2)], (0.5, 0.0, 0.0, 0.0, 2)),  # no positive present
    ([], (0.0, 0.0, 0.0, 0.0, 0)),
]


@pytest.mark.parametrize("data,want", CASES)
def test_binary_metrics(spark, data, want):
    df = spark.createDataFrame(data, "y int, p double").withColumn("pred", (F.col("p") > 0.5).cast("int"))
    assert tuple(evaluate.binary_metrics(df, "y", "pred").first()) == want


def test_gate(spark):
    m = spark.createDataFrame([(0.75,), (0.7499,), (None,)], "accuracy double")
    assert [r.passed for r in evaluate.quality_gate(m).collect()] == [True, False, False]


def test_report_of_three_classes(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (2, 2), (2, 2)]
    got = {r["class"]: r for r in evaluate.classification_report(spark.createDataFrame(pairs, "y int, p int"), "y", "p").collect()}
    for c in range(3):
        hit = sum(y == p == c for y, p in pairs)
        predicted, support = sum(p == c for _, p in pairs), sum(y == c for y, _ in pairs)
        assert (got[str(c)].precision, got[str(c)].recall, got[str(c)].support) == (hit / predicted, hit / support, support)
    assert got["macro avg"].recall == pytest.approx((0.5 + 1 + 2 / 3) / 3)
    assert got["weighted avg"].recall == pytest.approx(5 / 7)


def test_bias(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 0, 1), ("b", 1, 0), ("b", 0, 0)], "g string, y int, p int")
    r = evaluate.bias_gaps(df, "g", "y", "p").first()
    assert (r.demographic_parity_gap, r.equalized_odds_gap) == (1.0, 1.0)


def test_shares_and_tolerance(spark):
    log = spark.createDataFrame([("VariantA",)] * 129 + [("VariantB",)] * 23, "variant string")
    assert {r.variant: round(r.share_pct, 1) for r in abtest.distribution(log).collect()} == {"VariantA": 84.9, "VariantB": 15.1}
    checked = abtest.split_check(log, [("VariantA", 80), ("VariantB", 20)])
    assert all(r.within for r in checked.collect())
    assert not any(r.within for r in abtest.split_check(log, [("VariantA", 50), ("VariantB", 50)]).collect())


def test_assignment(spark):
    ids = spark.range(20_000)
    got = ids.select("id", abtest.assign_variant(F.col("id"), [("a", 80), ("b", 20)]).alias("v"))
    counts = {r.v: r["count"] for r in got.groupBy("v").count().collect()}
    assert sum(counts.values()) == 20_000 and abs(counts["a"] / 20_000 - 0.8) < 0.02
    forced = ids.select(abtest.assign_with_override(F.when(F.col("id") < 5, "b"), F.col("id"), [("a", 100), ("b", 0)]).alias("v"))
    assert forced.where("v = 'b'").count() == 5


def test_staged_ramp_only_moves_forward(spark):
    stages = [("2024-01-01", [("a", 80), ("b", 20)]), ("2024-01-08", [("a", 20), ("b", 80)])]
    before = abtest.assign_staged(F.lit("2024-01-05").cast("timestamp"), F.col("id"), stages)
    after = abtest.assign_staged(F.lit("2024-01-08").cast("timestamp"), F.col("id"), stages)
    got = spark.range(2000).select(before.alias("x"), after.alias("y"))
    assert got.where("x = 'b' AND y = 'a'").count() == 0 and got.where("x = 'a' AND y = 'b'").count() > 800


def test_promotion_needs_a_margin(spark):
    df = spark.createDataFrame([("old", i < 50) for i in range(100)] + [("new", i < 52) for i in range(100)], "v string, ok boolean")
    assert abtest.promotion(df, "v", F.col("ok"), "old", "new").first().promote is False
    assert abtest.promotion(df, "v", F.col("ok"), "old", "new", margin=0.01).first().promote is True


def test_speedup_and_size(spark):
    df = spark.createDataFrame([(64.3, 65.1), (10.0, 5.0), (5.0, 0.0)], "a double, b double")
    ratio, verdict = abtest.speedup(F.col("a"), F.col("b"))
    assert [(r.r and round(r.r, 2), r.v) for r in df.select(ratio.alias("r"), verdict.alias("v")).collect()] == [(0.99, "slower"), (2.0, "faster"), (None, None)]
    pct, kind = abtest.size_change(F.col("a"), F.col("b"))
    assert [r.k for r in df.select(kind.alias("k")).collect()] == ["increase", "reduction", "reduction"]


def test_latency_summary(spark):
    log = spark.range(100).select(F.lit("m").alias("model"), F.col("id").cast("double").alias("ms"))
    r = abtest.latency_summary(log, ["model"], "ms").first()
    assert (r.avg, r.n, r.p50, r.p95) == (49.5, 100, 50.0, 95.0)
    assert not math.isnan(r.avg)


def test_an_absent_variant_wins_nothing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "variant string, ms double")
    metrics = {"latency": (F.avg("ms"), "low"), "calls": (F.count(F.lit(1)).cast("double"), "high")}
    got = abtest.head_to_head(df, "variant", "a", "b", metrics).collect()
    assert len(got) == 2 and all(r.winner is None and r.value_a is not None and r.value_b is None for r in got)


def test_missing_measures_are_not_ok(spark):
    rows = spark.createDataFrame([(1.0, False), (2.0, False)], "x double, cur boolean")
    ks = drift.ks_shift(rows, ["x"], F.col("cur"))
    none = quality.conformance(rows.limit(0), {"x": "double"})
    psi = spark.createDataFrame([("x", None)], "feature string, psi double")
    got = {r.check_name: r.severity for r in drift.violation_report(ks=ks, conformance=none, psi=psi).collect()}
    assert got == {"ks": "unknown", "completeness": "unknown", "psi": "unknown"}


def test_no_baseline_no_alert(spark):
    rows = spark.createDataFrame([("d1", 5.0, "1"), ("d2", None, "x")], "day string, v double, raw string")
    got = {r.period: r.alert for r in drift.quality_by_period(rows, F.col("day"), "v", "raw", "bigint", F.lit(None).cast("double")).collect()}
    assert got == {"d1": None, "d2": None}
    known = {r.period: r.alert for r in drift.quality_by_period(rows, F.col("day"), "v", "raw", "bigint", F.lit(1.0)).collect()}
    assert known == {"d1": True, "d2": None}
