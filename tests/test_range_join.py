"""The range join against all pairs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import relational

START = datetime(2024, 1, 1)


def sides(spark, n=400, keys=5, hot=0.6, seed=1):
    draw = random.Random(seed)

    def rows(offset):
        out = []
        for i in range(n):
            key = "hot" if draw.random() < hot else draw.choice([*(f"k{j}" for j in range(keys)), None])
            at = None if draw.random() < 0.02 else START + timedelta(seconds=draw.randrange(4000) * 10)
            out.append((offset + i, key, at))
        return out

    a, b = rows(0), rows(10_000)
    return a, b, *(spark.createDataFrame(r, "id long, k string, ts timestamp").repartition(4) for r in (a, b))


def pairs(a, b, within):
    return sorted((x[0], y[0]) for x in a for y in b if x[1] is not None and x[1] == y[1] and x[2] and y[2] and y[2] <= x[2] and (within is None or y[2] > x[2] - timedelta(seconds=within)))


def got(df):
    return sorted((r.a, r.b) for r in df.select(F.col("_left.id").alias("a"), F.col("_right.id").alias("b")).collect())


@pytest.mark.parametrize("within", [None, 600, 10, 0.5, 100_000])
@pytest.mark.parametrize("cell_pairs", [10**9, 50])
def test_equals_all_pairs(spark, within, cell_pairs):
    a, b, left, right = sides(spark)
    assert got(relational.range_join(left, right, ["k"], "ts", "ts", within, cell_pairs=cell_pairs)) == pairs(a, b, within)


def test_a_hot_key_is_dealt_to_many_tasks(spark):
    _, _, left, right = sides(spark, 2000, hot=1.0)
    spread = relational.range_join(left, right, ["k"], "ts", "ts", cell_pairs=50_000)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) >= 6 and max(sizes) < 0.4 * sum(sizes)


def test_pairs_are_counted_first(spark):
    a, b, left, right = sides(spark)
    total = relational.range_cells(left, right, ["k"], "ts", "ts", 600).agg(F.sum(F.col("n_left") * F.col("n_right"))).first()[0]
    assert total >= len(pairs(a, b, 600))
    with pytest.raises(ValueError):
        relational.range_join(left, right, ["k"], "ts", "ts", 600, most_pairs=total - 1)


def test_empty_sides(spark):
    _, _, left, right = sides(spark, 20)
    assert got(relational.range_join(left.limit(0), right, ["k"], "ts", "ts", 60, most_pairs=1)) == []
