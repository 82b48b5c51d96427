"""Training and scoring."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import drift, evaluate, models as mx


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int)
    df = spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "id int, a double, b double, y int")
    return mx.assembled(df, ["a", "b"], "y")


@pytest.mark.parametrize("fit,floor", [
    (mx.fit_logistic, 0.95), (lambda d: mx.fit_forest(d, trees=15, depth=6), 0.95), (lambda d: mx.fit_boosted(d, rounds=8, depth=3), 0.93),
])
def test_beats_the_majority(table, fit, floor):
    rows = mx.scored(fit(table), table)
    m = evaluate.binary_metrics(rows, "label", "pred").first()
    assert m.accuracy > floor and m.samples_evaluated == 400
    assert rows.where("(p > 0.5) <> (pred = 1) AND p <> 0.5").count() == 0


def test_multiclass(spark):
    df = spark.createDataFrame([([float(c), float(i % 7)], float(c)) for c in range(3) for i in range(30)], "v array<double>, label double")
    df = mx.vector_column(df, "v")
    rows = mx.scored_multiclass(mx.fit_multiclass(df, rounds=2, depth=2), df)
    assert rows.where("pred = label").count() == 90


def test_logistic_penalty_is_per_table(table):
    """The weights minimise summed log loss + |w|^2 / (2c)."""
    w = mx.fit_logistic(table, c=0.5)
    beta = np.array([*w.coefficients.toArray(), w.intercept])
    data = np.array([(r.a, r.b, 1.0) for r in table.collect()])
    y = np.array([r.y for r in table.collect()])
    grad = data.T @ (1 / (1 + np.exp(-data @ beta)) - y) + np.array([beta[0], beta[1], 0]) / 0.5
    assert np.abs(grad).max() < 0.05


def test_variants(table):
    got = {r.variant: r for r in mx.compare_variants(table, table, {"small": {"rounds": 1, "depth": 1}, "big": {"rounds": 6, "depth": 4}}).collect()}
    assert got["big"].accuracy > got["small"].accuracy and got["big"].seconds > 0


def test_routed_scores(spark):
    df = spark.createDataFrame([(1, "m1", [1.0, 2.0]), (2, "m2", [1.0, 2.0]), (3, "none", [1.0, 2.0])], "id int, model string, v array<double>")
    weights = spark.createDataFrame([("m1", [1.0, 1.0], 0.5), ("m2", [0.0, -1.0], 0.0)], "model string, weights array<double>, b double")
    assert {r.id: r.score for r in mx.routed_scores(df, weights, "model", "v", "b").collect()} == {1: 3.5, 2: -2.0, 3: None}
    c = {r.model: r.weights for r in mx.centroids(df.unionByName(df.withColumn("v", F.array(F.lit(3.0), F.lit(4.0)))), "model", "v").collect()}
    assert c["m1"] == [2.0, 3.0]


def test_model_per_key_without_collecting_keys(spark):
    rng = np.random.default_rng(2)
    rows = [(k, float(a), float(b), float(k + 2 * a - b + rng.normal(0, 0.01))) for k in range(3) for a, b in rng.normal(size=(200, 2))]
    got = mx.fit_linear_by_key(spark.createDataFrame(rows, "k int, a double, b double, y double"), "k", ["a", "b"], "y").collect()
    for r in got:
        mine = np.array([x[1:] for x in rows if x[0] == r.k])
        want = np.linalg.lstsq(np.c_[np.ones(200), mine[:, :2]], mine[:, 2], rcond=None)[0]
        assert r.n == 200 and np.allclose(r.weights, want, atol=1e-6)


def test_rank_changes(spark):
    imp = spark.createDataFrame([("x", "a", 0.9), ("x", "b", 0.1), ("y", "a", 0.2), ("y", "b", 0.8)], "seg string, feature string, importance double")
    assert {r.feature: r.move for r in drift.rank_changes(imp, "seg", "x", "y").collect()} == {"a": -1, "b": 1}


def test_registered_models_have_their_whole_size(spark, monkeypatch):
    from millrace.plans import QUERIES, models

    asked = []
    monkeypatch.setattr(models.mx, "fit_multiclass", lambda df, **size: asked.append(size) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        QUERIES["multiclass_model"](spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(models.mx, "fit_logistic", lambda df: None)
    monkeypatch.setattr(models.mx, "fit_forest", lambda df, **size: asked.append(size))
    monkeypatch.setattr(models.mx, "fit_boosted", lambda df, **size: asked.append(size) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        QUERIES["fitted_model_facts"](spark, "/root/testdata/sf0.001")
    assert asked == [{"rounds": 100, "depth": 5, "key": "vec_id"}, {"trees": 100, "depth": 10}, {"rounds": 100, "depth": 5, "eta": 0.2, "key": "doc_id"}]


def test_variants_are_fitted_side_by_side(spark):
    # Each fit waits for the other one: one after the other, the barrier would break.
    meet = threading.Barrier(2)
    table = spark.createDataFrame([([float(i)], float(i > 20)) for i in range(40)], "x array<double>, label double")
    table = mx.vector_column(table, "x").select("features", "label")

    def fit(df, **params):
        meet.wait(timeout=60)
        return mx.fit_boosted(df, **params)

    got = mx.compare_variants(table, table, {"a": {"rounds": 1, "depth": 1}, "b": {"rounds": 2, "depth": 1}}, fit)
    assert [r.variant for r in got.collect()] == ["a", "b"]
