"""Job log, registry, listings and cost."""

from pyspark.sql import functions as F

from millrace.functions.time import micros
from millrace.operators import evaluate, lifecycle
from millrace.plans.monitoring import CELLS, SCORED, scored
from millrace.plans.registry import query

RULES = [
    {"rule": "data-arrived", "source": "storage", "detail": {"object_key": {"prefix": "7"}}},
    {"rule": "register", "detail_type": "purchase", "detail": {"status": ["Completed"]}},
    {"rule": "deploy", "source": "registry", "detail": {"status": ["Approved", "Completed"]}},
]


def lifecycle_events(t):
    """The events read as life-cycle events of one model per user."""
    k = F.get_json_object("props", "$.k").cast("int")
    status = F.when(k < 40, "Completed").when(k < 60, "Failed").when(k < 80, "Approved").otherwise("Deployed")
    return t.events.select(
        "event_id", "ts", F.col("user_id").alias("model_id"),
        F.when(F.col("event_type").isin("view", "click"), "storage").otherwise("registry").alias("source"),
        F.col("event_type").alias("detail_type"),
        F.struct(k.cast("string").alias("object_key"), status.alias("status")).alias("detail"),
    )


@query(
    "LIF1 DT-F4",
    """WITH s AS (SELECT o_orderstatus AS status, (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000.0 AS d FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
       SELECT status, count(*) AS steps, round(avg(d), 2) AS avg_duration_s, max(d)::DOUBLE AS max_duration_s FROM s GROUP BY 1""",
)
def step_summary(t):
    steps = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("start_time"), F.col("l_shipdate").alias("end_time")
    )
    return lifecycle.step_summary(lifecycle.step_durations(steps), ["status"]).withColumn("avg_duration_s", F.round("avg_duration_s", 2))


@query(
    "LIF2",
    """SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
       WHERE p IS NULL OR p <> event_type""",
)
def status_changes(t):
    return lifecycle.status_changes(t.events, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@query(
    "LIF3",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate DESC, o_orderkey DESC""",
)
def pending_models(t):
    registry = t.orders.withColumn("status", F.when(F.col("o_orderstatus") == "P", lifecycle.PENDING).otherwise("Done"))
    return lifecycle.pending(registry).orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).select("o_orderkey", "o_custkey")


@query(
    "LIF4",
    """WITH pick AS (SELECT o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders WHERE o_orderstatus = 'P') WHERE r = 1)
       SELECT CASE WHEN o_orderkey IN (SELECT o_orderkey FROM pick) THEN 'Approved' WHEN o_orderstatus = 'P' THEN 'PendingManualApproval' ELSE 'Rejected' END AS status, count(*) AS n
       FROM orders GROUP BY 1""",
)
def approved_registry(t):
    registry = t.orders.select(
        F.col("o_orderkey").alias("model_id"), F.col("o_custkey").alias("model_group"), F.col("o_orderdate").alias("created"),
        F.when(F.col("o_orderstatus") == "P", lifecycle.PENDING).otherwise("Rejected").alias("status"), F.col("o_orderdate").alias("status_time"),
    )
    chosen = lifecycle.latest_pending(registry, "created", "model_id", by=["model_group"])
    after = lifecycle.approve(registry, chosen, "model_id", F.col("status_time") + F.expr("INTERVAL 1 DAY"))
    return lifecycle.current_status(after, "model_id").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "LIF5 EVL8",
    f"""WITH {SCORED}, m AS (SELECT source, {CELLS} FROM scored GROUP BY 1), a AS (SELECT source, (tp + tn) / (tp + tn + fp + fn) AS acc FROM m)
        SELECT source AS job, round(acc, 6) AS accuracy, n AS trained_on, 'PendingManualApproval' AS status
        FROM a JOIN (SELECT source, count(*) AS n FROM documents GROUP BY 1) USING (source) WHERE acc >= 0.75 AND n > 0""",
)
def registration_rows(t):
    jobs = t.documents.groupBy(F.col("source").alias("job")).agg(F.count(F.lit(1)).alias("trained_on")).withColumn("job_status", F.lit("Completed"))
    metrics = evaluate.quality_gate(evaluate.binary_metrics(scored(t).withColumnRenamed("source", "job"), "y", "pred", by=["job"]))
    rows = lifecycle.registration_rows(jobs, metrics, "job")
    return rows.select("job", F.round("accuracy", 6).alias("accuracy"), "trained_on", "status")


@query(
    "LIF6",
    """SELECT p AS prefix, count(*) AS objects FROM pages, (SELECT unnest(['http://', 'https://', 'https://m.', 'http://blog.']) AS p) WHERE starts_with(url, p) GROUP BY 1""",
)
def deletion_plan(t):
    return lifecycle.deletion_plan(t.pages, ["http://", "https://", "https://m.", "http://blog."], "url")


@query(
    "LIF7",
    """WITH c AS (SELECT p_brand, sum(l_quantity / 24.0 * p_retailprice) AS separate, sum(l_quantity / 24.0 * p_retailprice * (1 - l_discount)) AS shared
                  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
       SELECT p_brand, round(separate, 6) AS separate, round(shared, 6) AS shared, round((separate - shared) * 100.0 / nullif(separate, 0), 4) AS savings_pct FROM c""",
)
def cost_roll_up(t):
    # Usage folds per part first; the price join then moves one row per part.
    usage = t.lineitem.groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity") / 24.0).alias("hours"), F.sum(F.col("l_quantity") / 24.0 * (1 - F.col("l_discount"))).alias("shared_hours")
    )
    priced = usage.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice"), "l_partkey")
    one = F.lit(1.0)
    separate = lifecycle.cost(priced, ["p_brand"], F.col("hours"), F.col("p_retailprice"), one).withColumnRenamed("cost", "separate")
    shared = lifecycle.cost(priced, ["p_brand"], F.col("shared_hours"), F.col("p_retailprice"), one).withColumnRenamed("cost", "shared")
    saved = F.try_divide((F.col("separate") - F.col("shared")) * 100.0, F.col("separate"))
    return separate.join(shared, "p_brand").select(
        "p_brand", F.round("separate", 6).alias("separate"), F.round("shared", 6).alias("shared"), F.round(saved, 4).alias("savings_pct")
    )


@query(
    "STR2",
    """WITH e AS (SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'storage' ELSE 'registry' END AS source, event_type, json_extract_string(props, '$.k') AS k FROM events),
            s AS (SELECT *, CASE WHEN k::INT < 40 THEN 'Completed' WHEN k::INT < 60 THEN 'Failed' WHEN k::INT < 80 THEN 'Approved' ELSE 'Deployed' END AS status FROM e)
       SELECT event_id, 'data-arrived' AS rule FROM s WHERE source = 'storage' AND starts_with(k, '7')
       UNION ALL SELECT event_id, 'register' FROM s WHERE event_type = 'purchase' AND status = 'Completed'
       UNION ALL SELECT event_id, 'deploy' FROM s WHERE source = 'registry' AND status IN ('Approved', 'Completed')""",
)
def matched_rules(t):
    return lifecycle.match_rules(lifecycle_events(t), RULES).select("event_id", "rule")
