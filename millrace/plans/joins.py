"""Joins and set operations."""

from pyspark.sql import functions as F

from millrace.functions import numeric as nx
from millrace.functions.time import micros
from millrace.operators import feature_store, relational
from millrace.operators.ordered import history_totals
from millrace.operators.prepare import assign_split
from millrace.plans.registry import query

BUCKET = "('0x' || substr(md5('42:' || o_orderkey), 1, 8))::BIGINT % 100"


@query(
    "JN1 FLT3 PRJ7 SRT6",
    """SELECT c_custkey AS user_id, c_mktsegment AS tier, p_partkey AS product_id, p_type AS category, p_retailprice AS price
       FROM customer CROSS JOIN part WHERE c_mktsegment = 'BUILDING' AND p_type = 'PROMO'
       ORDER BY c_custkey, p_partkey LIMIT 10""",
)
def first_segment_pairs(t):
    users = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("tier"))
    products = t.part.where("p_type = 'PROMO'").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"), F.col("p_retailprice").alias("price")
    )
    return relational.top_pairs(users, products, ["user_id"], ["product_id"], 10)


@query(
    "JN2 FS6",
    """SELECT p.event_id, p.user_id, count(v.event_id) AS versions, round(coalesce(sum(v.value), 0), 2) AS total
       FROM events p LEFT JOIN events v ON p.user_id = v.user_id AND v.event_type = 'view' AND v.ts <= p.ts
       WHERE p.event_type = 'purchase' GROUP BY p.event_id, p.user_id""",
)
def all_earlier_versions(t):
    purchases = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = t.events.where("event_type = 'view'").select("user_id", "ts", "value")
    totals = history_totals(
        purchases, views, ["user_id"], "ts", "ts", {"versions": F.lit(1), "total": F.col("value")}, "event_id"
    )
    return totals.select("event_id", "user_id", F.col("versions").cast("bigint").alias("versions"), F.round("total", 2).alias("total"))


@query(
    "JN2 FS6",
    """SELECT p.event_id, p.user_id, v.event_id AS view_id, round(v.value, 6) AS view_value FROM events p JOIN events v
       ON p.user_id = v.user_id AND v.ts <= p.ts AND v.ts > p.ts - INTERVAL 7 DAY WHERE p.event_type = 'purchase' AND v.event_type = 'view'""",
)
def versions_of_a_week(t):
    # The range join itself: every view of the seven days before a purchase.
    purchases = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = t.events.where("event_type = 'view'").select("event_id", "user_id", "ts", "value")
    pairs = relational.range_join(purchases, views, ["user_id"], "ts", "ts", within=7 * 86_400)
    return pairs.select("_left.event_id", "_left.user_id", F.col("_right.event_id").alias("view_id"), F.round("_right.value", 6).alias("view_value"))


@query(
    "JN2 FS6",
    """SELECT p.event_id, v.event_id AS view_id FROM events p JOIN events v
       ON p.user_id = v.user_id AND v.ts <= p.ts WHERE p.event_type = 'purchase' AND v.event_type = 'view'""",
)
def all_versions_in_grids(t):
    # Any time before, with a limit so low that every cell of a user is dealt into a grid.
    purchases = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = t.events.where("event_type = 'view'").select("event_id", "user_id", "ts")
    pairs = relational.range_join(purchases, views, ["user_id"], "ts", "ts", cell_pairs=20)
    return pairs.select("_left.event_id", F.col("_right.event_id").alias("view_id"))


@query(
    "JN3 FS6",
    """SELECT p.event_id, p.user_id, epoch_us(p.ts) AS event_us, v.value AS view_value, epoch_us(v.ts) AS feature_us
       FROM (SELECT * FROM events WHERE event_type = 'purchase') p
       ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def point_in_time_training(t):
    purchases = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = t.events.where("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), F.col("value").alias("view_value"))
    rows = feature_store.point_in_time(purchases, views, ["user_id"], "ts", "view_ts", ["view_value"])
    return rows.select("event_id", "user_id", micros(F.col("ts")).alias("event_us"), "view_value", micros(F.col("feature_time")).alias("feature_us"))


@query(
    "JN4 FS7 PRJ6 EXP9",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(p_brand, 'none') AS part_brand, coalesce(p_size, 0) AS part_size,
              coalesce(s_acctbal, 0.0) AS supplier_balance
       FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l_partkey = p_partkey
                     LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l_suppkey = s_suppkey""",
)
def request_vectors(t):
    parts = t.part.where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    suppliers = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_acctbal").alias("balance"))
    requests = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return feature_store.assemble_vectors(
        requests,
        [
            (parts, "l_partkey", "part_", {"part_brand": "none", "part_size": 0}),
            (suppliers, "l_suppkey", "supplier_", {"supplier_balance": 0.0}),
        ],
    )


@query("JN5", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def batch_key_lookup(t):
    wanted = t.orders.where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return relational.lookup(t.customer, wanted, "c_custkey").select("c_custkey", "c_name", "c_acctbal")


@query(
    "JN6 SET3",
    f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {BUCKET} < 80)",
)
def complement_of_sample(t):
    sample = assign_split(t.orders, "o_orderkey").where("split = 'train'")
    return t.orders.select("o_orderkey", "o_totalprice").join(sample.select("o_orderkey"), "o_orderkey", "left_anti")


@query(
    "JN8",
    """SELECT r.r_name AS region, count(*) AS customers, round(avg(c_acctbal), 4) AS balance
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region r ON n_regionkey = r_regionkey GROUP BY 1""",
)
def dictionary_join(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("region"))
    return (
        t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .groupBy("region")
        .agg(F.count(F.lit(1)).alias("customers"), F.round(F.avg("c_acctbal"), 4).alias("balance"))
    )


@query(
    "JN9",
    """WITH pred AS (SELECT o_orderkey AS request_id, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS pred FROM orders),
            act AS (SELECT l_orderkey AS request_id, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS actual FROM lineitem GROUP BY 1)
       SELECT pred, actual, count(*) AS n FROM pred JOIN act USING (request_id) GROUP BY 1, 2""",
)
def predictions_with_actuals(t):
    predictions = t.orders.select(F.col("o_orderkey").alias("request_id"), nx.flag(F.col("o_totalprice") > 250000).alias("pred"))
    # Late labels fold to one per request before the join.
    actuals = t.lineitem.groupBy(F.col("l_orderkey").alias("request_id")).agg(F.max(nx.flag(F.col("l_returnflag") == "R")).alias("actual"))
    return predictions.join(actuals, "request_id").groupBy("pred", "actual").agg(F.count(F.lit(1)).alias("n"))


@query(
    "JN10",
    """SELECT e.event_type, c.c_mktsegment AS segment, count(*) AS n, round(sum(e.value), 2) AS value
       FROM events e JOIN customer c ON e.user_id = c.c_custkey GROUP BY 1, 2""",
)
def events_with_entity(t):
    # Events fold per user first: the join moves one row per user and type.
    per_user = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    entity = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return per_user.join(entity, "user_id").groupBy("event_type", "segment").agg(F.sum("n").alias("n"), F.round(F.sum("value"), 2).alias("value"))


@query(
    "PRJ5",
    "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)",
)
def columns_side_by_side(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id")


@query("SET1 AGG11", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders ORDER BY 1, 2")
def distinct_sorted(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct().orderBy("o_orderstatus", "o_orderpriority")


@query(
    "SET2 SET4",
    """SELECT segment, event_type, count(*) AS n, round(avg(value), 6) AS mean
       FROM (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'normal' ELSE 'drifted' END AS segment, * FROM events)
       GROUP BY 1, 2""",
)
def tagged_halves(t):
    cut = F.lit("2024-01-16").cast("timestamp")
    both = relational.tagged_union("segment", {"normal": t.events.where(F.col("ts") < cut), "drifted": t.events.where(F.col("ts") >= cut)})
    return both.groupBy("segment", "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("SET3", "SELECT c_nationkey, c_mktsegment FROM customer EXCEPT ALL SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0")
def bag_complement(t):
    cols = ["c_nationkey", "c_mktsegment"]
    return t.customer.select(*cols).exceptAll(t.customer.where("c_acctbal < 0").select(*cols))
