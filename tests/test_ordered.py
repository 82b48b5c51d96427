"""Both plans of the ordered operators against brute force, on skewed data: one key
holds more than a third of the rows and many rows share time and value."""

import bisect

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import ordered
from tests.conftest import rows

# The first limit lets every group fit; the others force the chunked plan.
LIMITS = [1_000_000, 50, 7]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 600
    keys = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 12, n))
    times = np.where(rng.random(n) < 0.3, 40, rng.integers(0, 80, n))
    values = rng.integers(0, 15, n) / 2.0
    table = [(i, int(keys[i]), int(times[i]), float(values[i]) if i % 17 else None, bool(i % 3 == 0)) for i in range(n)]
    df = spark.createDataFrame(table, "id int, k int, t int, v double, cur boolean").repartition(5)
    return table, df


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("how", ["left", "inner"])
def test_asof(data, limit, how):
    table, df = data
    left = df.where("cur").select("id", "k", "t")
    right = df.where("NOT cur").select("k", F.col("t").alias("vt"), F.col("v").alias("fv"), F.col("id").alias("fid"))
    right = right.unionByName(right)  # replayed versions must not matter
    got = ordered.asof_join(left, right, ["k"], "t", "vt", ["fv", "fid"], tie=["fid"], how=how, limit=limit)
    want = []
    for i, k, t, _, cur in table:
        if not cur:
            continue
        best = max(((vt, fid, fv) for fid, vk, vt, fv, c in table if not c and vk == k and vt <= t), default=None, key=lambda x: x[:2])
        if best or how == "left":
            want.append((best and best[0], best and best[1], best and best[2], i, k, t))
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("limit", LIMITS)
def test_asof_never_matches_null_keys(spark, limit):
    left = spark.createDataFrame([(i, None, 5) for i in range(20)] + [(99, 1, 5)], "id int, k int, t int")
    right = spark.createDataFrame([(None, 1, 7), (1, 2, 8)], "k int, vt int, f int")
    got = ordered.asof_join(left, right, ["k"], "t", "vt", ["f"], limit=limit)
    assert {(r.id, r.f) for r in got.collect()} == {(i, None) for i in range(20)} | {(99, 8)}


@pytest.mark.parametrize("limit", LIMITS)
def test_history_totals(data, limit):
    table, df = data
    left = df.where("cur").select("id", "k", "t")
    right = df.where("NOT cur").select("k", F.col("t").alias("vt"), "v")
    got = ordered.history_totals(left, right, ["k"], "t", "vt", {"n": F.lit(1), "s": F.col("v")}, "id", limit=limit)
    want = []
    for i, k, t, _, cur in table:
        if cur:
            seen = [v for _, vk, vt, v, c in table if not c and vk == k and vt <= t]
            want.append((i, k, len(seen), float(sum(v or 0 for v in seen)), t))
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("limit", LIMITS)
def test_previous_row(data, limit):
    table, df = data
    got = ordered.previous_row(df, ["k"], ["t", "id"], ["v", "id"], limit=limit)
    want = []
    for k in {r[1] for r in table}:
        group = sorted((r for r in table if r[1] == k), key=lambda r: (r[2], r[0]))
        for before, row in zip([None, *group], group):
            want.append((row[4], row[0], k, before and before[0], before and before[3], row[2], row[3]))
    assert rows(got.select("cur", "id", "k", "prev_id", "prev_v", "t", "v")) == sorted(want, key=repr)


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("keys", [["k"], []])
def test_running_totals_and_index(data, limit, keys):
    table, df = data
    got = ordered.running_totals(df, keys, ["t", "id"], {"s": F.coalesce("v", F.lit(0.0))}, limit=limit)
    index = ordered.row_index(df, keys, ["t", "id"], limit=limit)
    sums, totals, place = {}, {}, {}
    for k in {r[1] if keys else 0 for r in table}:
        acc = 0.0
        group = sorted((r for r in table if not keys or r[1] == k), key=lambda r: (r[2], r[0]))
        for i, r in enumerate(group, 1):
            acc += r[3] or 0.0
            sums[r[0]], place[r[0]] = acc, i
        totals |= {r[0]: acc for r in group}
    assert {r.id: (r.s_upto, r.s_total) for r in got.collect()} == {i: (sums[i], totals[i]) for i in sums}
    assert {r.id: r.rn for r in index.collect()} == place
    assert set(index.columns) == {*df.columns, "rn"}


def test_after_first(data):
    table, df = data
    got = {r.id for r in ordered.after_first(df, ["k"], ["t", "id"], 5).collect()}
    want = set()
    for k in {r[1] for r in table}:
        want |= {r[0] for r in sorted((r for r in table if r[1] == k), key=lambda r: (r[2], r[0]))[5:]}
    assert got == want


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("keys", [["k"], []])
def test_quantiles(data, limit, keys):
    table, df = data
    probs = {"q10": 0.1, "q50": 0.5, "q95": 0.95, "q100": 1.0}
    for kind in ("interpolated", "positional"):
        got = ordered.exact_quantiles(df, keys, "v", probs, kind, limit=limit).collect()
        for r in got:
            values = sorted(x[3] for x in table if x[3] is not None and (not keys or x[1] == r.k))
            for name, p in probs.items():
                if kind == "positional":
                    assert r[name] == values[min(int(len(values) * p), len(values) - 1)]
                else:
                    assert r[name] == pytest.approx(float(np.quantile(values, p)), abs=1e-12)


def test_selection_in_rounds(spark, monkeypatch):
    """Few buckets and a small limit force all rounds; copies never fit the limit."""
    monkeypatch.setattr(ordered, "BUCKETS", 4)
    values = [float(i * i % 997) for i in range(900)] + [500.0] * 600
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "k int, v double")
    got = ordered.exact_quantiles(df, ["k"], "v", {"q": 0.37, "m": 0.5}, limit=20)
    for r in got.collect():
        mine = [v for i, v in enumerate(values) if i % 2 == r.k]
        assert (r.q, r.m) == (pytest.approx(np.quantile(mine, 0.37)), pytest.approx(np.quantile(mine, 0.5)))


def test_percentiles_of_hundred_calls(spark):
    calls = spark.range(100).select(F.col("id").cast("double").alias("ms"))
    r = ordered.exact_quantiles(calls, [], "ms", {"p50": 0.5, "p95": 0.95}, "positional").first()
    assert (r.p50, r.p95) == (50.0, 95.0)


@pytest.mark.parametrize("limit", LIMITS)
def test_ks(data, limit):
    table, df = data
    got = ordered.ks_distance(df, [], "v", F.col("cur"), limit=limit).first()
    swapped = ordered.ks_distance(df, [], "v", ~F.col("cur"), limit=limit).first()
    a = sorted(r[3] for r in table if r[3] is not None and not r[4])
    b = sorted(r[3] for r in table if r[3] is not None and r[4])
    want = max(abs(bisect.bisect_right(a, x) / len(a) - bisect.bisect_right(b, x) / len(b)) for x in a + b)
    assert got.ks == pytest.approx(want, abs=1e-12) and swapped.ks == pytest.approx(want, abs=1e-12)
    assert (got.n_baseline, got.n_current) == (len(a), len(b))


@pytest.mark.parametrize("limit", LIMITS)
def test_auc(data, limit):
    table, df = data
    got = ordered.rank_auc(df.withColumn("y", F.col("cur").cast("int")), [], "v", "y", limit=limit).first()
    pos = [r[3] for r in table if r[4] and r[3] is not None]
    neg = [r[3] for r in table if not r[4] and r[3] is not None]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert got.auc == pytest.approx(want, abs=1e-12)


def test_chunks_split_a_hot_key(data):
    _, df = data
    sizes = ordered.chunked(df, ["k"], ["t"], 20).groupBy("_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] < 150


def test_a_low_limit_makes_no_tiny_chunks(spark):
    df = spark.range(120_000).withColumn("k", F.lit(1))
    assert ordered.chunks_needed(df, ["k"], 60) == 3
    assert ordered.chunks_needed(df, ["k"], 120_000) == 0
    assert ordered.chunks_needed(df, ["k"], 100_000) == 2
