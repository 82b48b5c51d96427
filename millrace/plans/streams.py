"""Structured Streaming over the given files. Append mode emits closed windows only; `finished`
adds the windows still open at the end, so every check is over all rows."""

from pyspark.sql import functions as F

from millrace.functions.time import micros, utc
from millrace.operators import drift, lifecycle, stats
from millrace.operators.feature_store import latest
from millrace.operators.relational import latest_by
from millrace.plans.features import ACTIVITY
from millrace.plans.lifecycle import RULES, lifecycle_events
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.streaming import jobs

DELAY = "15 minutes"


def _stream(t, name="events", time="ts"):
    schema = t.spark.read.parquet(f"{t.folder}/{name}.parquet").schema
    return jobs.arriving(t.spark, t.folder, schema, f"{name}.parquet", time=time)


class _Live:
    """Tables whose events are the stream."""

    def __init__(self, t):
        self.events = _stream(t)


@query("STR1 SRC6", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1")
def new_objects(t):
    rows = jobs.drain(_stream(t).select("event_id", "event_type", "value"), "new-objects")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("value"))


@query(
    "STR2",
    """WITH e AS (SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'storage' ELSE 'registry' END AS source, event_type, json_extract_string(props, '$.k') AS k FROM events),
            s AS (SELECT *, CASE WHEN k::INT < 40 THEN 'Completed' WHEN k::INT < 60 THEN 'Failed' WHEN k::INT < 80 THEN 'Approved' ELSE 'Deployed' END AS status FROM e)
       SELECT rule, count(*) AS n FROM (
         SELECT 'data-arrived' AS rule FROM s WHERE source = 'storage' AND starts_with(k, '7')
         UNION ALL SELECT 'register' FROM s WHERE event_type = 'purchase' AND status = 'Completed'
         UNION ALL SELECT 'deploy' FROM s WHERE source = 'registry' AND status IN ('Approved', 'Completed')) GROUP BY 1""",
)
def streamed_rules(t):
    hits = lifecycle.match_rules(lifecycle_events(_Live(t)), RULES).select("event_id", "rule")
    return stats.value_counts(jobs.drain(hits, "rules"), ["rule"])


@query(
    "STR3 WIN4",
    """SELECT epoch_us(time_bucket(INTERVAL 5 MINUTE, ts)) AS start_us, event_type, count(*) AS n, round(sum(value), 4) AS total, max(value) AS high FROM events
        GROUP BY time_bucket(INTERVAL 5 MINUTE, ts), event_type""",
)
def streamed_windows(t):
    windows = jobs.finished(_stream(t), t.events, lambda df: jobs.windowed(df, "ts", DELAY, "5 minutes", ["event_type"], "value"), "ts", "5 minutes", "windows")
    return windows.select(micros(F.col("window_start")).alias("start_us"), "event_type", "n", F.round("total", 4).alias("total"), "high")


@query(
    "STR4",
    """WITH a AS (SELECT event_id, ts, time_bucket(INTERVAL 5 MINUTE, ts + to_minutes(json_extract_string(props, '$.k')::BIGINT)) AS batch FROM events),
            b AS (SELECT batch, max(ts) AS newest FROM a GROUP BY 1),
            m AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 15 MINUTE AS mark FROM b)
       SELECT coalesce(ts < mark, false) AS late, count(*) AS n FROM a JOIN m USING (batch) GROUP BY 1""",
)
def late_events(t):
    k = F.get_json_object("props", "$.k").cast("int")
    arrived = t.events.withColumn("arrival", F.col("ts") + F.make_dt_interval(mins=k))
    return stats.value_counts(jobs.late_rows(arrived, "ts", "arrival", "5 minutes", DELAY), ["late"])


@query(
    "STR4",
    """WITH a AS (SELECT event_id, ts, (epoch(ts - TIMESTAMP '2024-01-01')::BIGINT + user_id % 3 * 172800) // 691200 AS part FROM events),
            b AS (SELECT part, max(ts) AS newest FROM a GROUP BY 1),
            m AS (SELECT part, max(newest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 15 MINUTE AS mark FROM b)
       SELECT event_id, coalesce(ts < mark, false) AS late FROM a JOIN m USING (part)""",
)
def late_side_output(t):
    # Events that arrive in parts of eight days, two thirds of the users' days late; the stream is stopped and started again between parts.
    # Seconds are rounded, not cut, and the division is towards zero, both as in SQL.
    seconds = F.rint((F.unix_micros("ts") - F.unix_micros(F.lit("2024-01-01").cast("timestamp"))) / F.lit(1e6)).cast("bigint")
    days = F.call_function("div", seconds + F.col("user_id") % 3 * 172_800, F.lit(691_200))
    arrived = t.events.select("event_id", "user_id", "ts").withColumn("part", days)
    landing, path = scratch_path(t.spark, "landing"), scratch_path(t.spark, "late")
    for part in sorted(r.part for r in arrived.select("part").distinct().collect()):  # a part is a week or so
        arrived.where(F.col("part") == part).drop("part").write.mode("append").parquet(landing)
        kept, late = jobs.split_late(jobs.arriving(t.spark, landing, arrived.drop("part").schema, "*.parquet"), "ts", "15 minutes", path)
    return kept.select("event_id", F.lit(False).alias("late")).unionByName(late.select("event_id", F.lit(True).alias("late")))


@query(
    "STR5 SNK7 FS3",
    "SELECT user_id, event_type, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
)
def streamed_feature_ingest(t):
    raw = _stream(t).withColumn("event_time", micros(F.col("ts")) / F.lit(1000000.0))
    history, _ = jobs.ingest_stream(raw, ACTIVITY, scratch_path(t.spark, "history"))
    return latest(history, ACTIVITY, ["event_id"]).drop("event_time")


@query(
    "STR5 FS2",
    """SELECT event_type, count(*) AS n, min(event_id) AS first_event FROM events WHERE json_extract_string(props, '$.k') LIKE '%9' GROUP BY 1""",
)
def streamed_rejects(t):
    # Ids that end in 9 are no numbers here: these records must come out on the other side.
    k = F.get_json_object("props", "$.k")
    raw = _stream(t).withColumn("event_time", micros(F.col("ts")) / F.lit(1000000.0)).withColumn("user_id", F.when(k.endswith("9"), F.concat(F.lit("x"), k)).otherwise(k))
    _, rejected = jobs.ingest_stream(raw, ACTIVITY, scratch_path(t.spark, "history"))
    return rejected.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


@query(
    "STR6 DRF3",
    """WITH b AS (SELECT event_type, avg(value) AS baseline FROM events GROUP BY 1), w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS s, event_type, count(*) AS n, avg(value) AS mean FROM events GROUP BY 1, 2)
        SELECT epoch_us(s) AS start_us, event_type, n, round(mean, 6) AS mean, round((mean - baseline) * 100.0 / nullif(baseline, 0), 4) AS change_pct, abs((mean - baseline) * 100.0 / baseline) > 20 AS alert
        FROM w JOIN b USING (event_type)""",
)
def streamed_monitor(t):
    baseline = t.events.groupBy("event_type").agg(F.avg("value").alias("mean"))
    rows = jobs.finished(_stream(t), t.events, lambda df: jobs.monitored(df, baseline, "ts", DELAY, "6 hours", "event_type", "value"), "ts", "6 hours", "monitor")
    return rows.select(
        micros(F.col("window_start")).alias("start_us"), "event_type", "n", F.round("mean", 6).alias("mean"), F.round("change_pct", 4).alias("change_pct"), "alert"
    )


_BINS = 20
_WINDOW_BINS = f"""lm AS (SELECT min(value) AS low, max(value) AS high FROM events),
  bn AS (SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS s, (SELECT count(*) FROM range(1, {_BINS}) r(i), lm WHERE value > low + i * (high - low) / {_BINS}) AS bin FROM events),
  ob AS (SELECT i, count(bin) / (SELECT count(*) FROM bn)::DOUBLE AS o FROM range({_BINS}) r(i) LEFT JOIN bn ON bin = i GROUP BY 1),
  ws AS (SELECT event_type, s, count(*) AS n FROM bn GROUP BY 1, 2), wb AS (SELECT event_type, s, bin, count(*) AS c FROM bn GROUP BY 1, 2, 3),
  al AS (SELECT ws.event_type, ws.s, ws.n, ob.i, o, coalesce(c, 0) AS c, coalesce(c, 0) / ws.n::DOUBLE AS a FROM ws, ob LEFT JOIN wb ON wb.event_type = ws.event_type AND wb.s = ws.s AND wb.bin = ob.i),
  cu AS (SELECT *, sum(a) OVER w AS ca, sum(o) OVER w AS co, sum(c) OVER w AS cc FROM al WINDOW w AS (PARTITION BY event_type, s ORDER BY i))"""


@query(
    "STR6 DRF4 DRF5",
    f"""WITH {_WINDOW_BINS} SELECT epoch_us(s) AS start_us, event_type, any_value(n) AS n, round(sum((greatest(a, 0.0001) - greatest(o, 0.0001)) * ln(greatest(a, 0.0001) / greatest(o, 0.0001))), 4) AS psi,
        round(max(abs(ca - co)), 6) AS ks, round(any_value(low) + (min(i) FILTER (cc >= ceil(n * 0.5)) + 1) * (any_value(high) - any_value(low)) / {_BINS}, 6) AS p50,
        round(any_value(low) + (min(i) FILTER (cc >= ceil(n * 0.95)) + 1) * (any_value(high) - any_value(low)) / {_BINS}, 6) AS p95
        FROM cu, lm GROUP BY 1, 2""",
)
def streamed_distribution(t):
    # Whole distributions of the captured stream in windows, against fixed bins of the table at rest.
    low, high = t.events.agg(F.min("value"), F.max("value")).first()
    edges = [low + i * (high - low) / _BINS for i in range(1, _BINS)]
    above = sum((F.when(F.col("value") > e, 1).otherwise(0) for e in edges), F.lit(0))
    seen = {r.bin: r.n for r in t.events.groupBy(above.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a bin
    windows = jobs.finished(_stream(t), t.events, lambda df: jobs.distribution(df, edges, "ts", DELAY, "6 hours", ["event_type"], "value"), "ts", "6 hours", "bins")
    rows = jobs.distribution_drift(windows, [seen.get(i, 0) for i in range(_BINS)], edges, (low, high))
    return rows.select(micros(F.col("window_start")).alias("start_us"), "event_type", "n", *[F.round(c, d).alias(c) for c, d in (("psi", 4), ("ks", 6), ("p50", 6), ("p95", 6))])


_MOVES = """s AS (SELECT user_id AS model_id, ts, CASE WHEN k < 40 THEN 'Completed' WHEN k < 60 THEN 'Failed' WHEN k < 80 THEN 'Approved' ELSE 'Deployed' END AS status
         FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events)),
  c AS (SELECT model_id, min(ts) AS moved_at FROM s WHERE status = 'Completed' GROUP BY 1),
  a AS (SELECT s.model_id, min(ts) AS moved_at FROM s JOIN c ON s.model_id = c.model_id AND s.ts > c.moved_at WHERE status = 'Approved' GROUP BY 1),
  p AS (SELECT s.model_id, min(ts) AS moved_at FROM s JOIN a ON s.model_id = a.model_id AND s.ts > a.moved_at WHERE status = 'Deployed' GROUP BY 1),
  moves AS (SELECT model_id, '' AS from_status, 'PendingManualApproval' AS to_status, moved_at FROM c UNION ALL SELECT model_id, 'PendingManualApproval', 'Approved', moved_at FROM a
            UNION ALL SELECT model_id, 'Approved', 'Deployed', moved_at FROM p)"""


def _moves(t):
    live = lifecycle_events(_Live(t)).select("model_id", "ts", F.col("detail.status").alias("status"))
    path, schema = jobs.moving_events(live, "model_id", "status", "ts")
    return jobs.drain(jobs.transitions(jobs.arriving(t.spark, f"{path}/*", schema), "model_id", "status", "ts"), "moves")


@query("STR7 UDF2", f"WITH {_MOVES} SELECT model_id, from_status, to_status, epoch_us(moved_at) AS moved_us FROM moves")
def lifecycle_transitions(t):
    return _moves(t).select("model_id", "from_status", "to_status", micros(F.col("moved_at")).alias("moved_us"))


@query(
    "STR8",
    f"""WITH {_MOVES} SELECT model_id, 'Model ' || model_id || ': ' || CASE from_status WHEN '' THEN 'new' ELSE from_status END || ' -> ' || to_status AS message FROM moves""",
)
def state_notifications(t):
    return jobs.notifications(_moves(t), "model_id").select("model_id", "message")


@query(
    "STR9",
    "SELECT event_id, event_type, value, 2::BIGINT AS copies FROM events",
)
def replay_suppressed(t):
    def twice(df):
        return df.unionByName(df)

    once = jobs.finished(
        twice(_stream(t)), twice(t.events), lambda df: jobs.deduplicated(df, "event_id", "ts", DELAY, "1 hour", ["event_type", "value"]), "ts", "1 hour", "once"
    )
    return once.drop("ts")


@query(
    "STR10 JN9",
    """SELECT o_orderpriority, count(*) AS outcomes, sum((l_returnflag = 'R')::INT)::BIGINT AS returned FROM orders JOIN lineitem ON o_orderkey = l_orderkey
         AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 60 DAY GROUP BY 1""",
)
def streamed_outcomes(t):
    predictions = _stream(t, "orders", "o_orderdate").select("o_orderkey", "o_orderdate", "o_orderpriority")
    outcomes = _stream(t, "lineitem", "l_shipdate").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag")
    joined = jobs.joined_outcomes(
        predictions, outcomes, "o_orderkey", "o_orderdate", "l_shipdate", F.struct("l_linenumber", "l_partkey"), "60 DAYS", "90 days",
        jobs.outcome_salts(t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey"),
    )
    rows = jobs.drain(joined, "outcomes")
    return rows.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("outcomes"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
