"""Feature groups on the small users/products fixture."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import to_records
from millrace.operators import feature_store as fs, relational

T0, T1 = 1_705_000_000.0, 1_707_000_000.0
USERS = fs.FeatureGroup(
    "users-features", "user_id", "event_time",
    {"user_id": "String", "age": "Integral", "membership_tier": "String", "total_purchases": "Integral",
     "avg_order_value": "Fractional", "event_time": "Fractional"},
)
PRODUCTS = fs.FeatureGroup(
    "products", "product_id", "event_time",
    {"product_id": "String", "category": "String", "price": "Fractional", "avg_rating": "Fractional", "stock_level": "Integral",
     "event_time": "Fractional"},
)


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [
            ("user_001", 28, "gold", 47, 125.50, T0), ("user_002", 35, "silver", 12, 45.00, T0), ("user_003", 42, "platinum", 156, 312.75, T0),
            ("user_004", 23, "bronze", 3, 28.99, T0), ("user_005", 51, "gold", 89, 178.25, T0),
        ],
        USERS.schema,
    )


@pytest.fixture(scope="module")
def history(spark, users):
    return users.unionByName(spark.createDataFrame([("user_001", 28, "platinum", 67, 142.75, T1)], USERS.schema))


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [
            ("prod_001", "electronics", 299.99, 4.5, 150, T0), ("prod_002", "clothing", 49.95, 4.2, 500, T0), ("prod_003", "home", 89.00, 3.8, 75, T0),
            ("prod_004", "electronics", 599.99, 4.9, 25, T0), ("prod_005", "sports", 34.50, 4.0, 200, T0),
        ],
        PRODUCTS.schema,
    )


def test_definition_is_validated():
    with pytest.raises(ValueError, match="not a declared feature"):
        fs.FeatureGroup("g", "id", "t", {"t": "Fractional"})
    with pytest.raises(ValueError, match="Fractional epoch"):
        fs.FeatureGroup("g", "id", "t", {"id": "String", "t": "String"})
    with pytest.raises(ValueError, match="feature types"):
        fs.FeatureGroup("g", "id", "t", {"id": "Text", "t": "Fractional"})
    assert USERS.table == "users_features" and USERS.values == ["age", "membership_tier", "total_purchases", "avg_order_value"]


def test_high_value_users(users):
    got = fs.training_query(
        users, USERS, ["user_id", "total_purchases", "avg_order_value"], (F.col("total_purchases") > 10) & (F.col("avg_order_value") > 50)
    ).orderBy(F.col("total_purchases").desc())
    assert [tuple(r) for r in got.collect()] == [("user_003", 156, 312.75), ("user_005", 89, 178.25), ("user_001", 47, 125.50)]


def test_gold_electronics_pairs(users, products):
    got = relational.top_pairs(
        users.where("membership_tier = 'gold'").select("user_id"), products.where("category = 'electronics'").select("product_id"),
        ["user_id"], ["product_id"], 10,
    )
    assert [tuple(r) for r in got.collect()] == [(u, p) for u in ("user_001", "user_005") for p in ("prod_001", "prod_004")]


def test_latest_and_batch_get(spark, history):
    got = {r.user_id: r.total_purchases for r in fs.latest(history, USERS).collect()}
    assert got == {"user_001": 67, "user_002": 12, "user_003": 156, "user_004": 3, "user_005": 89}
    ids = spark.createDataFrame([("user_001",), ("user_001",), ("nobody",)], "user_id string")
    assert [(r.user_id, r.membership_tier) for r in fs.get_records(history, USERS, ids).collect()] == [("user_001", "platinum")]
    assert fs.training_query(history, USERS, ["user_id"], latest_only=True).count() == 5
    assert fs.training_query(history, USERS, ["user_id"]).count() == 6


def test_version_change(history):
    got = fs.version_changes(history, ["user_id"], ["event_time"], "total_purchases").where("change IS NOT NULL").collect()
    assert [(r.user_id, r.prev_total_purchases, r.total_purchases, r.change) for r in got] == [("user_001", 47, 67, 20)]


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_point_in_time(spark, history, limit):
    mid = (T0 + T1) / 2
    sales = spark.createDataFrame(
        [("t1", "user_001", 10.0, T0 - 1), ("t2", "user_001", 20.0, mid), ("t3", "user_001", 30.0, T1), ("t4", "user_001", 40.0, T1 + 9)],
        "transaction_id string, user_id string, purchase_amount double, event_time double",
    )
    features = history.select("user_id", F.col("event_time").alias("as_of"), "total_purchases", "membership_tier")
    args = (["user_id"], "event_time", "as_of", ["total_purchases", "membership_tier"])
    got = fs.point_in_time(sales, features, *args, limit=limit)
    assert {r.transaction_id: (r.total_purchases, r.membership_tier) for r in got.collect()} == {
        "t1": (None, None), "t2": (47, "gold"), "t3": (67, "platinum"), "t4": (67, "platinum")
    }
    assert fs.point_in_time(sales, features, *args, how="inner", limit=limit).count() == 3
    assert got.where("feature_time > event_time").count() == 0
    audit = fs.leakage_audit(sales, features, ["user_id"], "event_time", "as_of", "total_purchases", limit=limit)
    assert {r.method: (r.leaking, r.n_rows) for r in audit.collect()} == {"newest": (2, 4), "point_in_time": (0, 4)}


def test_feature_vectors(spark, users, products):
    requests = spark.createDataFrame([("user_002", "prod_003"), ("user_404", "prod_001")], "user_id string, product_id string")
    got = fs.assemble_vectors(
        requests,
        [
            (users.drop("event_time"), "user_id", "user_", {"user_age": 0, "user_membership_tier": "unknown", "user_total_purchases": 0, "user_avg_order_value": 0.0}),
            (products.drop("event_time"), "product_id", "product_", {"product_category": "unknown", "product_price": 0.0}),
        ],
    )
    by_user = {r.user_id: r for r in got.collect()}
    r = by_user["user_002"]
    assert (r.user_age, r.user_membership_tier, r.user_total_purchases, r.user_avg_order_value) == (35, "silver", 12, 45.0)
    assert (r.product_category, r.product_price, r.product_avg_rating, r.product_stock_level) == ("home", 89.0, 3.8, 75)
    r = by_user["user_404"]
    assert (r.user_age, r.user_membership_tier, r.product_category) == (0, "unknown", "electronics")


def test_records_round_trip_and_ingest(spark, users, tmp_path):
    wire = users.select(to_records(list(USERS.features)).alias("records"))
    assert sorted(map(tuple, fs.decode_records(wire, "records", USERS).collect())) == sorted(map(tuple, users.collect()))
    raw = spark.createDataFrame(
        [("u1", "30", "gold", "1", "2.5", "100.5"), (None, "30", "gold", "1", "2.5", "100.5"), ("u2", "old", "gold", "1", "2.5", "100.5"), ("u3", None, None, None, None, "7")],
        "user_id string, age string, membership_tier string, total_purchases string, avg_order_value string, event_time string",
    )
    rejected = fs.ingest(raw, USERS, str(tmp_path / "h"))
    assert sorted(map(str, (r.user_id for r in rejected.collect()))) == ["None", "u2"]
    assert {r.user_id for r in spark.read.parquet(str(tmp_path / "h")).collect()} == {"u1", "u3"}
    assert {r.status: r.n for r in fs.ingest_counts(raw, USERS).collect()} == {"accepted": 2, "rejected": 2}
