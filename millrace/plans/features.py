"""Feature-store queries."""

from pyspark.sql import functions as F

from millrace.functions.time import micros
from millrace.operators import feature_store, snapshots
from millrace.plans.registry import query
from millrace.session import scratch_path

ACTIVITY = feature_store.FeatureGroup(
    "user-activity", "user_id", "event_time",
    {"user_id": "Integral", "event_type": "String", "value": "Fractional", "event_time": "Fractional", "event_id": "Integral"},
)


def activity(t):
    """The events as versions of one feature group."""
    return t.events.withColumn("event_time", micros(F.col("ts")) / F.lit(1000000.0)).select(*ACTIVITY.features)


@query(
    "FS1 FS2 EXP10",
    """SELECT CASE WHEN length(p) > 1 AND p NOT LIKE '%9' THEN 'accepted' ELSE 'rejected' END AS status, count(*) AS n
       FROM (SELECT json_extract_string(props, '$.k') AS p FROM events) GROUP BY 1""",
)
def ingest_counts(t):
    # Ids shorter than two digits are missing, those ending in 9 are no numbers.
    k = F.get_json_object("props", "$.k")
    raw = t.events.select(
        F.when(F.length(k) > 1, F.when(k.endswith("9"), F.concat(F.lit("x"), k)).otherwise(k)).alias("user_id"),
        "event_type", F.col("value").cast("string").alias("value"),
        (micros(F.col("ts")) / F.lit(1000000.0)).cast("string").alias("event_time"), "event_id",
    )
    return feature_store.ingest_counts(raw, ACTIVITY)


@query(
    "FS3 WIN1",
    """SELECT user_id, event_type, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def latest_features(t):
    return feature_store.latest(activity(t), ACTIVITY, ["event_id"]).drop("event_time")


@query(
    "FS4 JN5",
    """SELECT user_id, event_type, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events
         WHERE user_id IN (SELECT user_id FROM events WHERE value > 300)) WHERE r = 1""",
)
def batch_get(t):
    ids = t.events.where("value > 300").select("user_id")
    return feature_store.get_records(activity(t), ACTIVITY, ids, ["event_id"]).drop("event_time")


VIEW_COLUMNS = ["user_id", "ts", "event_id", "event_type", "value"]


def _kept_view(t):
    """A latest view that has taken in the events of four periods, the newest period first."""
    rows = t.events.select(*VIEW_COLUMNS)
    view = snapshots.LatestView(t.spark, scratch_path(t.spark, "latest"), rows.schema, ["user_id"], ["ts", "event_id"])
    part = F.pmod(F.dayofmonth("ts"), F.lit(4))
    for k in range(4):
        view.merge(rows.where(part == 3 - k), f"part {k}")
    return view


@query(
    "FS3 SNK7",
    "SELECT user_id, event_type, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
)
def maintained_latest(t):
    return _kept_view(t).read().select("user_id", "event_type", "value", "event_id")


@query(
    "FS4 JN5",
    """SELECT user_id, event_type, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events
         WHERE user_id IN (SELECT user_id FROM events WHERE value > 300)) WHERE r = 1""",
)
def maintained_lookup(t):
    return _kept_view(t).lookup(t.events.where("value > 300").select("user_id")).select("user_id", "event_type", "value", "event_id")


@query(
    "FS5 FLT2 SRT2",
    """SELECT c.c_custkey AS user_id, count(*) AS total_purchases, round(avg(o_totalprice), 6) AS avg_order_value
       FROM customer c JOIN orders o ON c_custkey = o_custkey GROUP BY 1 HAVING count(*) > 10 AND avg(o_totalprice) > 250000
       ORDER BY total_purchases DESC, user_id""",
)
def high_value_users(t):
    users = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count(F.lit(1)).alias("total_purchases"), F.avg("o_totalprice").alias("avg_order_value")
    )
    group = feature_store.FeatureGroup(
        "users", "user_id", "event_time",
        {"user_id": "Integral", "total_purchases": "Integral", "avg_order_value": "Fractional", "event_time": "Fractional"},
    )
    known = users.join(t.customer.select(F.col("c_custkey").alias("user_id")), "user_id", "left_semi")
    rows = feature_store.training_query(
        known, group, ["user_id", "total_purchases", "avg_order_value"],
        (F.col("total_purchases") > 10) & (F.col("avg_order_value") > 250000),
    )
    return rows.withColumn("avg_order_value", F.round("avg_order_value", 6)).orderBy(F.col("total_purchases").desc(), "user_id")


@query(
    "FS5",
    """SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
       WHERE r = 1 AND value > 10""",
)
def latest_training_rows(t):
    return feature_store.training_query(
        activity(t), ACTIVITY, ["user_id", "event_type", "value"], F.col("value") > 10, latest_only=True, tie=["event_id"]
    )


@query(
    "FS6 JN3",
    """SELECT p.event_id, v.value AS view_value, v.event_id AS view_id
       FROM (SELECT * FROM events WHERE event_type = 'purchase') p
       ASOF JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def point_in_time_inner(t):
    purchases = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = t.events.where("event_type = 'view'").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("value").alias("view_value"), F.col("event_id").alias("view_id")
    )
    rows = feature_store.point_in_time(purchases, views, ["user_id"], "ts", "view_ts", ["view_value", "view_id"], how="inner")
    return rows.select("event_id", "view_value", "view_id")


@query(
    "FS8",
    """WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), v AS (SELECT * FROM events WHERE event_type = 'view'),
            newest AS (SELECT user_id, max(ts) AS ts FROM v GROUP BY 1)
       SELECT 'newest' AS method, count(*) FILTER (n.ts > p.ts) AS leaking, count(*) AS n_rows FROM p LEFT JOIN newest n USING (user_id)
       UNION ALL SELECT 'point_in_time', 0, (SELECT count(*) FROM p)""",
)
def leakage_audit(t):
    purchases = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = t.events.where("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), "value")
    return feature_store.leakage_audit(purchases, views, ["user_id"], "ts", "view_ts", "value")


@query(
    "FS9",
    """SELECT event_type, round((epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts))) / 1000000.0, 3) AS lag_seconds FROM events GROUP BY 1""",
)
def feature_freshness(t):
    as_of = t.events.agg(F.max("ts")).scalar()
    rows = feature_store.freshness(t.events, ["event_type"], "ts", as_of)
    return rows.withColumn("lag_seconds", F.round("lag_seconds", 3))
