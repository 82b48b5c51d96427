"""Windows, sorts and top-k."""

from pyspark.sql import functions as F

from millrace.functions.time import micros, period_start
from millrace.operators import lifecycle, relational, stats
from millrace.operators.ordered import after_first, previous_row, row_index
from millrace.plans.registry import query


@query(
    "WIN1 FS3",
    """SELECT user_id, event_id, event_type, value, epoch_us(ts) AS us
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def latest_version(t):
    rows = relational.latest_by(t.events, ["user_id"], ["ts", "event_id"])
    return rows.select("user_id", "event_id", "event_type", "value", micros(F.col("ts")).alias("us"))


@query(
    "WIN2",
    """SELECT event_id, user_id, value, lag(value) OVER w AS prev_value, round(value - lag(value) OVER w, 4) AS change
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def version_changes(t):
    from millrace.operators.feature_store import version_changes as changes

    rows = changes(t.events, ["user_id"], ["ts", "event_id"], "value")
    return rows.select("event_id", "user_id", "value", "prev_value", F.round("change", 4).alias("change"))


@query(
    "WIN3 LAT3",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
       SELECT user_id, count(*) AS n, round(max(value) FILTER (rn = 1), 4) AS cold, round(avg(value) FILTER (rn > 1), 6) AS warm_mean FROM r GROUP BY 1""",
)
def cold_and_warm_calls(t):
    first = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min_by("value", F.struct("ts", "event_id")).alias("cold"))
    warm = after_first(t.events, ["user_id"], ["ts", "event_id"], 1).groupBy("user_id").agg(F.avg("value").alias("warm_mean"))
    return first.join(warm, "user_id", "left").select("user_id", "n", F.round("cold", 4).alias("cold"), F.round("warm_mean", 6).alias("warm_mean"))


@query(
    "WIN4 SRT3",
    """SELECT epoch_us(time_bucket(INTERVAL 5 MINUTE, ts)) AS start_us, event_type, count(*) AS n, round(avg(value), 6) AS mean
       FROM events GROUP BY 1, 2 ORDER BY 1, 2""",
)
def five_minute_windows(t):
    return (
        t.events.groupBy(micros(period_start(F.col("ts"), "5 minutes")).alias("start_us"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))
        .orderBy("start_us", "event_type")
    )


@query(
    "WIN4",
    "SELECT epoch_us(time_bucket(INTERVAL 30 MINUTE, ts)) AS start_us, count(*) AS n, max(value) AS high FROM events GROUP BY 1",
)
def half_hour_windows(t):
    return t.events.groupBy(micros(period_start(F.col("ts"), "30 minutes")).alias("start_us")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("high")
    )


@query("WIN5", "SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) % 5 AS slot FROM events")
def round_robin(t):
    return row_index(t.events.select("event_id"), [], ["event_id"]).select("event_id", F.pmod(F.col("rn") - 1, F.lit(5)).alias("slot"))


@query(
    "WIN6",
    """SELECT user_id, count(*) AS calls, sum(CASE WHEN p IS NOT NULL AND event_type <> p THEN 1 ELSE 0 END)::BIGINT AS switches
       FROM (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) GROUP BY 1""",
)
def model_switches(t):
    rows = previous_row(t.events, ["user_id"], ["ts", "event_id"], ["event_type"])
    return rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.col("event_type") != F.col("prev_event_type")).alias("switches")
    )


@query("SRT1", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey")
def sorted_ascending(t):
    return t.customer.select("c_custkey", "c_acctbal").orderBy("c_acctbal", "c_custkey")


@query("SRT2 FLT2", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000 ORDER BY o_totalprice DESC, o_orderkey")
def sorted_descending(t):
    return t.orders.where("o_totalprice > 200000").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey")


@query("SRT4", "SELECT p_name, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_name LIMIT 5")
def top_five(t):
    return stats.top_k(stats.value_counts(t.part, ["p_name"]), 5, tie=["p_name"])


@query("SRT7", "SELECT o_orderkey, o_orderstatus, epoch_us(o_orderdate) AS us FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10")
def newest_page(t):
    page = relational.newest(t.orders, "o_orderdate", "o_orderkey", 10)
    return page.select("o_orderkey", "o_orderstatus", micros(F.col("o_orderdate")).alias("us"))


@query(
    "SRT8 LIF3",
    """SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) AS us
       FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders WHERE o_orderstatus = 'P') WHERE r = 1""",
)
def latest_pending(t):
    registry = t.orders.withColumn("status", F.when(F.col("o_orderstatus") == "P", lifecycle.PENDING).otherwise("Done"))
    rows = lifecycle.latest_pending(registry, "o_orderdate", "o_orderkey", by=["o_custkey"])
    return rows.select("o_custkey", "o_orderkey", micros(F.col("o_orderdate")).alias("us"))
