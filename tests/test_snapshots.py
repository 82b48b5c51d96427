"""Tables that change at once, and the maintained latest view."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import snapshots
from millrace.operators.relational import latest_by

SCHEMA = "id long, at long, v string"


def rows(seed, n, ids=300):
    draw = random.Random(seed)
    return [(draw.randrange(ids), draw.randrange(10_000) * 10 + seed, f"v{seed}-{i}") for i in range(n)]


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def newest(data):
    out = {}
    for r in data:
        if r[0] not in out or r[1] > out[r[0]][1]:
            out[r[0]] = r
    return sorted(out.values())


def distinct_times(data):
    return list({(r[0], r[1]): r for r in data}.values())


def view(spark, path, buckets=16):
    return snapshots.LatestView(spark, str(path), table(spark, []).schema, ["id"], ["at"], buckets)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_merges_equal_the_latest_of_all_rows(spark, tmp_path):
    own, seen = view(spark, tmp_path), []
    assert own.read().count() == 0
    for seed in range(4):
        delta = distinct_times(rows(seed, 200))
        seen = distinct_times(seen + delta)
        assert own.merge(table(spark, delta), f"batch {seed}") == seed + 1
        assert got(own.read()) == newest(seen) == got(latest_by(table(spark, seen), ["id"], ["at"]).select("id", "at", "v"))
    assert snapshots.current(spark, str(tmp_path))[2] == "batch 3"
    own.merge(table(spark, []))
    assert got(own.read()) == newest(seen)


def test_a_merge_rewrites_only_its_buckets(spark, tmp_path):
    own = view(spark, tmp_path)
    own.merge(table(spark, [(i, 1, "a") for i in range(300)]))
    before = snapshots.current(spark, str(tmp_path))[1]
    own.merge(table(spark, [(7, 2, "b")]))
    after = snapshots.current(spark, str(tmp_path))[1]
    assert [b for b in after if after[b] != before[b]] == [table(spark, [(7, 0, "")]).select(own.bucket()).first()[0]]


def test_lookup_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    own = view(spark, tmp_path, 64)
    own.merge(table(spark, [(i, 1, "a") for i in range(2000)]))
    ids = table(spark, [(i, 0, "") for i in [*range(5), 99_999]]).select("id")
    found = own.lookup(ids)
    wanted = {r[0] for r in ids.select(own.bucket()).distinct().collect()}
    folders = snapshots.current(spark, str(tmp_path))[1]
    files = {f.rsplit("/", 1)[0].rsplit("/data/")[1] for f in found.inputFiles()}
    assert files == {folders[b].removeprefix("data/") for b in wanted if b in folders} and len(files) <= 6 < len(folders)
    assert got(found) == [(i, 1, "a") for i in range(5)]
    plan = found._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [In(id" in plan.toString()


def test_lookup_of_many_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "FILTERED_KEYS", 3)
    own = view(spark, tmp_path)
    own.merge(table(spark, rows(1, 500)))
    ids = spark.range(20).select("id")
    assert got(own.lookup(ids)) == [r for r in got(own.read()) if r[0] < 20]


def test_an_interrupted_merge_leaves_the_old_view(spark, tmp_path, monkeypatch):
    own = view(spark, tmp_path)
    own.merge(table(spark, rows(1, 200)))
    before = got(own.read())
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_switch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            own.merge(table(spark, rows(2, 200)))
    assert got(own.read()) == before
    own.merge(table(spark, rows(2, 200)))
    assert len(got(own.read())) >= len(before) and got(own.read()) != before


def test_two_keys_and_nulls(spark, tmp_path):
    schema = "a string, b int, at long, v string"
    own = snapshots.LatestView(spark, str(tmp_path), spark.createDataFrame([], schema).schema, ["a", "b"], ["at"], 4)
    data = [("x", 1, 1, "old"), ("x", 1, 2, "new"), ("x", None, 1, "n"), (None, None, 5, "m"), ("y", 2, 3, "z")]
    own.merge(spark.createDataFrame(data, schema))
    assert own.read().count() == 4
    found = own.lookup(spark.createDataFrame([("x", 1), ("q", 9)], "a string, b int"))
    assert [r.v for r in found.collect()] == ["new"]


def test_publish_switches_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    with pytest.raises(ValueError):
        snapshots.published(spark, path)
    assert snapshots.publish(table(spark, rows(1, 50)), path, "nightly") == 1
    first = snapshots.published(spark, path)
    old = got(first)
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_switch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            snapshots.publish(table(spark, rows(2, 50)), path, "nightly")
    assert got(snapshots.published(spark, path)) == old
    failing = table(spark, rows(3, 5)).select("id", F.raise_error(F.lit("broken")).cast("long").alias("at"), "v")
    with pytest.raises(Exception, match="broken"):
        snapshots.publish(failing, path, "nightly")
    assert got(snapshots.published(spark, path)) == old
    for _ in range(2):
        snapshots.publish(table(spark, rows(2, 60)), path, "nightly")
    assert len(got(snapshots.published(spark, path))) == 60
    assert got(first) == old  # who has begun to read goes on with what was there
