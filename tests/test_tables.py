"""Quality, preparation, statistics, joins."""

import re
import statistics

import pytest
from pyspark.sql import functions as F

from millrace.operators import prepare, quality, relational, stats
from tests.conftest import rows

PEOPLE = [
    # Survived, Pclass, Name, Sex, Age, SibSp, Parch, Fare, Embarked
    (0, 3, "Alder, Mr. Tom", "male", 22.0, 1, 0, 7.25, "S"),
    (1, 1, "Birch, Mrs. Ada", "female", 38.0, 1, 0, 71.28, "C"),
    (1, 3, "Cedar, Miss. Eve", "female", None, 0, 0, 7.92, "S"),
    (0, 2, "Plain Name", "unknown", 35.0, 0, 0, None, None),
    (1, 1, "Elm, Dona. Ines", "female", 39.0, 0, 0, 108.9, "C"),
    (0, 3, "Fir, Master. Max", "male", 2.0, 3, 1, 21.07, "Q"),
    (1, 2, "Grove, Mlle. Lia", "female", 28.7, 0, 0, 13.0, "C"),
    (0, 3, "Holm, Mr. Jon", "male", None, 0, 0, 7.9, "S"),
]
SCHEMA = "Survived int, Pclass int, Name string, Sex string, Age double, SibSp int, Parch int, Fare double, Embarked string"


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, SCHEMA)


def test_null_profile_in_one_pass(people):
    got = {r.column_name: r.nulls for r in quality.null_profile(people).where("nulls > 0").collect()}
    assert got == {"Age": 2, "Fare": 1, "Embarked": 1}


def test_imputation(people):
    df = prepare.impute_median(people, ["Age", "Fare"])
    df = prepare.impute_mode(df, ["Embarked"])
    ages = [p[4] for p in PEOPLE if p[4] is not None]
    fares = [p[7] for p in PEOPLE if p[7] is not None]
    got = {r.Name: r for r in df.collect()}
    assert got["Cedar, Miss. Eve"].Age == statistics.median(ages)
    assert got["Plain Name"].Fare == statistics.median(fares)
    assert got["Plain Name"].Embarked == "C"  # C and S tie, the smaller one wins


def test_fit_on_train_only(people):
    train = people.where("Pclass = 3")
    got = prepare.impute_median(people, ["Age"], fit_on=train).where("Name LIKE 'Holm%'").first()
    assert got.Age == statistics.median([22.0, 2.0])


def test_constant_keeps_its_fraction(people):
    got = prepare.impute_constant(people.withColumn("n", F.lit(None).cast("int")), {"n": 28.7}).first()
    assert got.n == 28.7


def test_title_codes(people):
    code = prepare.title_code(
        F.col("Name"), {"Mr": 1, "Miss": 2, "Mrs": 3, "Master": 4, "Rare": 5}, {"Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs"}, ["Dona", "Dr"]
    )
    assert [r[0] for r in people.select(code).collect()] == [1, 3, 2, 0, 5, 4, 2, 1]


def test_checks(people):
    got = {r.check_name: r.failures for r in quality.violations(people, not_null=["Age"], domains={"Embarked": ["S", "C"]}).collect()}
    assert got == {"not_empty": 0, "not_null:Age": 2, "domain:Embarked": 2}
    assert quality.violations(people.limit(0)).first().failures == 1
    assert quality.require(people, not_null=["Survived"]) is people
    with pytest.raises(ValueError, match="not_null:Age: 2"):
        quality.require(people, not_null=["Age"])


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert [r.x for r in prepare.nan_to_null(df, ["x"]).collect()] == [1.0, None, None]


def test_splits_are_disjoint_complete_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r.k: r.split for r in prepare.assign_split(df.repartition(7), "k").collect()}
    b = {r.k: r.split for r in prepare.assign_split(df.coalesce(1), "k").collect()}
    assert a == b and set(a.values()) == {"train", "test"} and len(a) == 1000
    exact = prepare.assign_exact_split(df, "k", 70).groupBy("split").count()
    assert {r.split: r["count"] for r in exact.collect()} == {"train": 700, "test": 300}


def test_describe(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 10)], "x double")
    r = stats.describe(df, ["x"]).first()
    assert (r["count"], r["mean"], r["min"], r.q25, r.q50, r.q75, r["max"]) == (9, 5.0, 1.0, 3.0, 5.0, 7.0, 9.0)
    assert r["std"] == round(statistics.stdev(range(1, 10)), 2)


def test_extremes_keep_the_first_on_ties(spark):
    df = spark.createDataFrame([(3, 0.9), (1, 0.9), (2, 0.1), (4, 0.1)], "id int, s double")
    r = stats.extreme_rows(df, "s", "id", []).first()
    assert (r.highest.id, r.lowest.id) == (1, 2)


@pytest.mark.parametrize("limit", [1000, 0])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_with_a_hot_key(spark, limit, how):
    fact = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).cast("int").alias("k"))
    # Hot as well: a key the side does not know, and NULL.
    lost = spark.range(6000, 9000).select("id", F.when(F.col("id") % 2 == 0, 99).cast("int").alias("k"))
    fact = fact.unionByName(lost)
    side = spark.createDataFrame([(k, f"v{k}", None if k == 5 else k) for k in range(30)], "k int, v string, w int")
    got = relational.lookup_join(fact, side, "k", how, limit=limit)
    assert got.columns == ["id", "k", "v", "w"]
    assert rows(got) == rows(fact.join(side, "k", how))
    pairs = relational.lookup_join_by(fact.withColumn("z", F.lit(1)), side.withColumn("z", F.lit(1)), ["k", "z"], how, limit=limit)
    assert rows(pairs.drop("z")) == rows(got)
    sized = side.withColumn("n", F.when(F.col("k") == 7, 1700).otherwise(100))
    assert rows(relational.lookup_join(fact, sized, "k", how, size="n", limit=limit).drop("n")) == rows(got)


@pytest.mark.parametrize("limit", [1000, 0])
def test_lookup_join_of_maps_and_copies(spark, limit):
    one = spark.createDataFrame([(1, {"a": 1}, 7), (1, {"a": 1}, 7), (2, None, None)], "id int, m map<string,int>, k int")
    fact = one.unionByName(one)
    side = spark.createDataFrame([(7, "x", {"b": 2})], "k int, v string, n map<string,int>")
    got = relational.lookup_join(fact, side, "k", limit=limit)
    assert got.columns == ["id", "m", "k", "v", "n"] and got.dtypes == fact.join(side, "k", "left").select(*got.columns).dtypes
    assert rows(got) == rows(fact.join(side, "k", "left"))


def test_broadcast_is_decided_by_bytes(spark, monkeypatch):
    side = spark.createDataFrame([(1, "x" * 500)], "k int, v string")
    assert relational.fits_broadcast(side) and not relational.fits_broadcast(side, most_bytes=100) and not relational.fits_broadcast(side, limit=0)


def test_string_ids_and_missing_scores(spark):
    df = spark.createDataFrame([("b/2", 0.9), ("a/1", 0.9), ("c/3", None), ("z", 0.1), ("y", 0.1)], "id string, s double")
    r = stats.extreme_rows(df, "s", "id", []).first()
    assert (r.highest.id, r.lowest.id) == ("a/1", "y")


def test_imputation_plans_one_scan_more(spark):
    """However many columns are filled, the fitted values are read once."""
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    df = prepare.impute_mode(lines, cols)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    planned = len(set(re.findall(r"Subquery subquery#(\d+)", plan)))
    assert planned - plan.count("ReusedSubquery") <= 1  # the others read the first one's result


def test_heavy_keys_are_few(spark):
    sizes = spark.range(50_000).select(F.col("id").alias("k"), F.when(F.col("id") < 3, 1_000_000).otherwise(1).alias("n"))
    assert {r.k for r in relational.heavy_keys(sizes).collect()} == {0, 1, 2}


@pytest.mark.parametrize("k", [1, 3, 7, 50])
@pytest.mark.parametrize("nl,nr", [(5, 4), (1, 9), (9, 1), (0, 3), (3, 0)])
def test_top_pairs_is_the_head_of_the_product(spark, k, nl, nr):
    left = spark.range(nl).select((F.col("id") * 7 % 11).alias("a"))
    right = spark.range(nr).select((F.col("id") * 5 % 13).alias("b"))
    want = sorted((i * 7 % 11, j * 5 % 13) for i in range(nl) for j in range(nr))[:k]
    assert [tuple(r) for r in relational.top_pairs(left, right, ["a"], ["b"], k).collect()] == want
