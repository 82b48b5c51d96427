"""Boosted trees against a plain version, and against Spark's own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import boosting, models as mx


def table(spark, x, y, parts=4):
    rows = [(i, [None if v is None or np.isnan(v) else float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id int, features array<double>, label int").repartition(parts)


def planted(n, seed=1, classes=2, d=5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)), 2)
    x[rng.random((n, d)) < 0.05] = np.nan
    z = np.nan_to_num(x)
    score = np.stack([z[:, k % d] * z[:, (k + 1) % d] + z[:, (2 * k) % d] for k in range(classes)], 1) + rng.normal(0, 0.3, (n, classes))
    return x, (score[:, 1] > score[:, 0]).astype(int) if classes == 2 else score.argmax(1)


def plain_tree(x, g, h, cuts, depth, s, node=0):
    """(node, feature, cut, missing left) and leaf values of a tree, by trying every cut on the rows."""
    at = {node: (-s.eta * g.sum() / (h.sum() + s.l2),)}
    if depth == 0:
        return at
    best = None
    for f in range(x.shape[1]):
        for side in (False, True):
            for cut in [*cuts[f], np.inf]:
                left = np.where(np.isnan(x[:, f]), side, x[:, f] <= cut)
                gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
                gain = (gl**2 / (hl + s.l2) + gr**2 / (hr + s.l2) - (gl + gr) ** 2 / (hl + hr + s.l2)) / 2 - s.gain
                if hl >= s.weight and hr >= s.weight and gain > 1e-9 and (best is None or round(gain, 9) > best[0]):
                    best = (round(gain, 9), f, cut, side, left)
    if best is None:
        return at
    _, f, cut, side, left = best
    at[node] += (f, cut, side)
    at |= plain_tree(x[left], g[left], h[left], cuts, depth - 1, s, 2 * node + 1)
    at |= plain_tree(x[~left], g[~left], h[~left], cuts, depth - 1, s, 2 * node + 2)
    return at


@pytest.mark.parametrize("classes,rounds", [(2, 3), (3, 2)])
def test_trees_equal_a_plain_version(spark, classes, rounds):
    x, y = planted(500, classes=classes)
    got = boosting.fit(table(spark, x, y), classes=classes, rounds=rounds, depth=3, eta=0.5, bins=20)
    margin = np.zeros((500, got.margins))
    for trees in got.rounds:
        g, h = boosting.slopes(margin, y)
        for k, tree in enumerate(trees):
            want = plain_tree(x, g[:, k] / boosting.UNIT, h[:, k] / boosting.UNIT, got.cuts, 3, got.settings)
            for node, (value, *cut) in want.items():
                assert tree.feature[node] == (cut[0] if cut else -1)
                if cut:
                    assert (tree.cut[node], bool(tree.missing_left[node])) == (cut[1], cut[2])
                else:
                    assert abs(tree.value[node] - value) < 1e-9
        margin = boosting._added([trees], x, np.isnan(x), False, margin)
    assert np.allclose(got.scores(x), margin)


def test_one_pass_a_level(spark, monkeypatch):
    passes = []
    real = boosting._level_sums
    monkeypatch.setattr(boosting, "_level_sums", lambda *a: passes.append(a[3]) or real(*a))
    x, y = planted(400)
    boosting.fit(table(spark, x, y), rounds=2, depth=3)
    assert passes == [0, 1, 2, 0, 1, 2]


def test_partitions_do_not_matter(spark):
    x, y = planted(300)
    one, many = (boosting.fit(table(spark, x, y, p), rounds=3, depth=3, subsample=0.7, key="id").scores(x) for p in (1, 7))
    assert np.array_equal(one, many)


def test_many_features_and_kept_scores(spark, monkeypatch):
    """Several blocks of features; scores of earlier rounds are in the table."""
    x, y = planted(300, d=9)
    want = boosting.fit(table(spark, x, y), rounds=5, depth=2).scores(x)
    monkeypatch.setattr(boosting, "BLOCK_FEATURES", 4)
    monkeypatch.setattr(boosting, "KEPT_ROUNDS", 2)
    assert np.allclose(boosting.fit(table(spark, x, y), rounds=5, depth=2).scores(x), want)


def test_subsample_takes_its_share():
    key = np.arange(100_000) * 7919
    rounds = [boosting.taken(key, r, boosting.Settings(subsample=0.8)) for r in range(3)]
    assert all(abs(t.mean() - 0.8) < 0.01 for t in rounds)
    assert abs((rounds[0] & rounds[1]).mean() - 0.64) < 0.01



def test_as_good_as_first_order(spark):
    x, y = planted(1500, seed=3)
    x = np.nan_to_num(x)
    df = mx.vector_column(table(spark, x, y), "features").withColumn("label", F.col("label").cast("double")).persist()
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")

    def ranked(rows):
        p = sorted((r.p, r.label) for r in rows.select("p", "label").collect())
        values = np.array(p)
        ranks = np.array([(np.searchsorted(values[:, 0], v, "left") + np.searchsorted(values[:, 0], v, "right") + 1) / 2 for v in values[:, 0]])
        good = values[:, 1] == 1
        return (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())

    second = ranked(mx.scored(mx.fit_boosted(train, rounds=20, depth=4, key="id"), test))
    first = ranked(mx.scored(mx.fit_first_order(train, rounds=20, depth=4), test))
    assert second >= first - 0.003 and second > 0.9
    df.unpersist()


def test_many_classes_beat_one_against_the_rest(spark):
    x, y = planted(1200, seed=4, classes=4)
    df = mx.vector_column(table(spark, np.nan_to_num(x), y), "features").withColumn("label", F.col("label").cast("double")).persist()
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    share = lambda m: mx.scored_multiclass(m, test).agg(F.avg((F.col("pred") == F.col("label")).cast("int"))).first()[0]
    assert share(mx.fit_multiclass(train, rounds=10, depth=3)) >= share(mx.fit_one_against_rest(train, rounds=10, depth=3))
    df.unpersist()


def test_missing_and_constant_features(spark):
    rng = np.random.default_rng(2)
    x = np.c_[np.where(rng.random(200) < 0.5, np.nan, 1.0), np.ones(200)]
    y = np.isnan(x[:, 0]).astype(int)
    model = boosting.fit(table(spark, x, y), rounds=5, depth=2)
    rows = boosting.scored(model, table(spark, x, y))
    assert rows.where("pred <> label").count() == 0
    assert model.importances()[0] == 1.0


def test_wrong_input(spark):
    with pytest.raises(ValueError):
        boosting.fit(spark.createDataFrame([], "features array<double>, label int"))
    with pytest.raises(ValueError):
        boosting.fit(spark.createDataFrame([([1.0], 2)], "features array<double>, label int"))
    with pytest.raises(ValueError):
        boosting.fit(spark.createDataFrame([([1.0], 1), ([1.0, 2.0], 0)], "features array<double>, label int"))


def test_binned_rows_travel_in_batches(spark):
    """A batch of rows is one row of arrays, and the way by bins ends where the way by values does."""
    x, y = planted(300, d=3)
    model = boosting.fit(table(spark, x, y), rounds=2, depth=3)
    rows = table(spark, x, y, 2).select(F.col("id").cast("long").alias("key"), F.col("label").alias("y"), F.col("features").alias("x"))
    binned = rows.mapInArrow(boosting._binned(model.cuts, 1), boosting._BINNED)
    assert binned.count() == 2
    missing = max(map(len, model.cuts)) + 1
    for key, _, bins, _ in boosting._unpacked(binned.toArrow().to_batches(), 3, 1):
        own = x[key]
        for tree in (t for trees in model.rounds for t in trees):
            assert np.array_equal(tree.leaves(bins.T, missing, True), tree.leaves(own, np.isnan(own), False))
