"""Permutation importance against a plain version."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import attribution, boosting, drift


def windows(spark, n=900, seed=3):
    """The label follows feature a in window one and feature b in window two."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 3)
    rows = [(i, "one" if i < n // 2 else "two", [float(v) for v in r], int(r[0 if i < n // 2 else 1] > 0)) for i, r in enumerate(x)]
    return rows, spark.createDataFrame(rows, "id long, win string, features array<double>, label int")


def partners(rows, bucket_rows):
    """The row that each row takes its features from."""
    out = {}
    for win in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == win]
        buckets = math.ceil(len(own) / bucket_rows)
        digest = {r[0]: hashlib.md5(f"0:{r[0]}".encode()).hexdigest() for r in own}
        for b in range(buckets):
            cycle = sorted((r for r in own if int(digest[r[0]][:15], 16) % buckets == b), key=lambda r: (digest[r[0]], r[0]))
            out |= {r[0]: s for r, s in zip(cycle, cycle[1:] + cycle[:1], strict=True)}
    return out


@pytest.mark.parametrize("bucket_rows", [10_000, 50])
def test_equals_plain_version(spark, bucket_rows):
    rows, df = windows(spark, 300)
    model = boosting.fit(df, rounds=4, depth=3)
    got = attribution.permutation_importance(df, lambda d: boosting.scored(model, d), ["a", "b", "c"], "id", ["win"], bucket_rows=bucket_rows)
    other = partners(rows, bucket_rows)
    assert sorted(s[0] for s in other.values()) == sorted(other)

    def loss(r, x):
        p = model.probabilities(np.array([x]))[0, 1]
        return -math.log(p if r[3] else 1 - p)

    seen = {(r.win, r.feature): (r.n, r.loss, r.importance) for r in got.collect()}
    for win in ("one", "two"):
        own = [r for r in rows if r[1] == win]
        base = sum(loss(r, r[2]) for r in own) / len(own)
        for f, name in enumerate("abc"):
            changed = sum(loss(r, [*r[2][:f], other[r[0]][2][f], *r[2][f + 1 :]]) for r in own) / len(own)
            assert seen[win, name] == pytest.approx((len(own), base, changed - base))


def test_a_lost_feature_changes_its_rank(spark):
    _, df = windows(spark)
    first = df.where("win = 'one'")
    model = boosting.fit(first.unionByName(df.where("win = 'two' AND id % 2 = 0")), rounds=30, depth=4)
    # Feature c joins the windows by nothing; a leads where the label follows it.
    got = attribution.permutation_importance(df, lambda d: boosting.scored(model, d), ["a", "b", "c"], "id", ["win"])
    moves = {r.feature: r.move for r in drift.rank_changes(got, "win", "one", "two").collect()}
    assert moves["a"] < 0 < moves["b"]


def test_rows_alone_and_null_windows(spark):
    df = spark.createDataFrame([(1, None, [1.0]), (2, "x", [2.0]), (3, None, [3.0])], "id long, win string, v array<double>")
    got = {r.id: r.partner for r in attribution.exchanged(df, "id", "v", ["win"]).collect()}
    assert got == {1: [3.0], 2: [2.0], 3: [1.0]}
    whole = attribution.exchanged(df, "id", "v").collect()
    assert sorted(r.partner[0] for r in whole) == [1.0, 2.0, 3.0] and all(r.partner != r.v for r in whole)


def test_losses(spark):
    row = spark.range(1).select(
        attribution.log_loss(F.lit(0.25), F.lit(0)).alias("a"), attribution.multiclass_log_loss(F.array(F.lit(0.5), F.lit(0.0)), F.lit(1)).alias("b")).first()
    assert row.a == pytest.approx(-math.log(0.75)) and row.b == pytest.approx(-math.log(1e-15))
