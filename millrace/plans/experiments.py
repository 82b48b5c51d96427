"""A/B tests and call-log latency."""

from pyspark.sql import functions as F

from millrace.functions.time import micros, period_start
from millrace.operators import abtest, relational, stats
from millrace.plans.registry import query

WEIGHTS = [("champion", 80.0), ("challenger", 20.0)]
STAGES = [
    ("2024-01-01", [("champion", 80.0), ("challenger", 20.0)]),
    ("2024-01-08", [("champion", 50.0), ("challenger", 50.0)]),
    ("2024-01-15", [("champion", 20.0), ("challenger", 80.0)]),
    ("2024-01-22", [("champion", 0.0), ("challenger", 100.0)]),
]
BUCKET = "('0x' || substr(md5('ab:' || user_id), 1, 8))::BIGINT % 10000"
CALLS = f"calls AS (SELECT *, CASE WHEN {BUCKET} < 8000 THEN 'champion' ELSE 'challenger' END AS variant FROM events)"


def calls(t):
    return t.events.withColumn("variant", abtest.assign_variant(F.col("user_id"), WEIGHTS))


@query("AB1", f"WITH {CALLS} SELECT user_id, variant, count(*) AS n FROM calls GROUP BY 1, 2")
def weighted_variants(t):
    return calls(t).groupBy("user_id", "variant").agg(F.count(F.lit(1)).alias("n"))


@query(
    "AB2",
    f"""SELECT event_id, CASE WHEN event_type = 'signup' THEN 'challenger' WHEN {BUCKET} < 8000 THEN 'champion' ELSE 'challenger' END AS variant FROM events""",
)
def forced_variant(t):
    target = F.when(F.col("event_type") == "signup", "challenger")
    return t.events.select("event_id", abtest.assign_with_override(target, F.col("user_id"), WEIGHTS).alias("variant"))


@query("AB3 AGG9", f"WITH {CALLS} SELECT variant, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct FROM calls GROUP BY 1")
def variant_distribution(t):
    return abtest.distribution(calls(t)).withColumn("share_pct", F.round("share_pct", 6))


@query(
    "AB4 FLT6",
    f"""WITH {CALLS}, d AS (SELECT variant, count(*) * 100.0 / sum(count(*)) OVER () AS share FROM calls GROUP BY 1)
        SELECT variant, round(share, 6) AS share_pct, CASE variant WHEN 'champion' THEN 80.0::DOUBLE ELSE 20.0::DOUBLE END AS expected_pct,
               share BETWEEN CASE variant WHEN 'champion' THEN 70 ELSE 10 END AND CASE variant WHEN 'champion' THEN 90 ELSE 30 END AS within FROM d""",
)
def split_tolerance(t):
    return abtest.split_check(calls(t), WEIGHTS).drop("n").withColumn("share_pct", F.round("share_pct", 6))


@query(
    "AB5 WIN4",
    f"""WITH {CALLS} SELECT variant, epoch_us(time_bucket(INTERVAL 5 MINUTE, ts)) AS period_us, count(*) AS n FROM calls GROUP BY 1, 2""",
)
def invocations_by_period(t):
    return relational.period_counts(calls(t), ["variant"], micros(period_start(F.col("ts"), "5 minutes")), "period_us")


@query(
    "AB6 AGG17",
    f"""WITH {CALLS}, p AS (SELECT variant, time_bucket(INTERVAL 30 MINUTE, ts) AS b, avg(value) AS m, min(value) AS lo, max(value) AS hi, sum(value) AS s, count(*) AS n FROM calls GROUP BY 1, 2)
        SELECT variant, round(avg(m), 6) AS mean_of_periods, round(sum(s) / sum(n), 6) AS weighted_mean, min(lo) AS min, max(hi) AS max, count(*) AS periods FROM p GROUP BY 1""",
)
def latency_over_windows(t):
    rows = stats.two_level_mean(calls(t), ["variant"], period_start(F.col("ts"), "30 minutes"), "value")
    return rows.withColumns({c: F.round(c, 6) for c in ("mean_of_periods", "weighted_mean")})


@query(
    "AB7",
    f"""WITH {CALLS}, m AS (SELECT avg(value) FILTER (variant = 'champion') AS la, avg(value) FILTER (variant = 'challenger') AS lb,
                 avg((event_type = 'error')::INT) FILTER (variant = 'champion') AS ea, avg((event_type = 'error')::INT) FILTER (variant = 'challenger') AS eb,
                 (count(*) FILTER (variant = 'champion'))::DOUBLE AS ca, (count(*) FILTER (variant = 'challenger'))::DOUBLE AS cb FROM calls),
             r AS (SELECT unnest(['latency', 'errors', 'calls']) AS metric, unnest([la, ea, ca]) AS a, unnest([lb, eb, cb]) AS b, unnest([-1, -1, 1]) AS s FROM m)
        SELECT metric, round(a, 6) AS value_a, round(b, 6) AS value_b, CASE WHEN a = b THEN 'tie' WHEN s * a > s * b THEN 'champion' ELSE 'challenger' END AS winner FROM r""",
)
def head_to_head(t):
    rows = abtest.head_to_head(
        calls(t), "variant", "champion", "challenger",
        {
            "latency": (F.avg("value"), "low"),
            "errors": (F.avg((F.col("event_type") == "error").cast("double")), "low"),
            "calls": (F.count(F.lit(1)), "high"),
        },
    )
    return rows.withColumns({c: F.round(c, 6) for c in ("value_a", "value_b")})


@query(
    "AB8",
    """WITH s AS (SELECT l.doc_id, quality = (CASE WHEN n_chars / (n_chars + 500.0) > 0.5 THEN 1 ELSE 0 END) AS ok,
                   CASE WHEN ('0x' || substr(md5('ab:' || l.doc_id), 1, 8))::BIGINT % 10000 < 8000 THEN 'champion' ELSE 'challenger' END AS variant
            FROM labels l JOIN documents d USING (doc_id)),
       a AS (SELECT avg(ok::INT) FILTER (variant = 'champion') AS champion, avg(ok::INT) FILTER (variant = 'challenger') AS challenger FROM s)
       SELECT round(champion, 6) AS champion, round(challenger, 6) AS challenger, challenger > champion + 0.02 AS promote FROM a""",
)
def promotion_rule(t):
    scored = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").withColumn(
        "variant", abtest.assign_variant(F.col("doc_id"), WEIGHTS)
    )
    right = F.col("quality") == (F.col("n_chars") / (F.col("n_chars") + 500.0) > 0.5).cast("int")
    rows = abtest.promotion(scored, "variant", right, "champion", "challenger")
    return rows.withColumns({c: F.round(c, 6) for c in ("champion", "challenger")})


@query(
    "AB9",
    f"""WITH w AS (SELECT ts, {BUCKET} AS bucket, CASE WHEN ts < TIMESTAMP '2024-01-08' THEN 8000 WHEN ts < TIMESTAMP '2024-01-15' THEN 5000
                         WHEN ts < TIMESTAMP '2024-01-22' THEN 2000 ELSE 0 END AS edge FROM events)
        SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN bucket < edge THEN 'champion' ELSE 'challenger' END AS variant, count(*) AS n FROM w GROUP BY 1, 2""",
)
def staged_ramp(t):
    staged = t.events.withColumn("variant", abtest.assign_staged(F.col("ts"), F.col("user_id"), STAGES))
    return staged.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "variant").agg(F.count(F.lit(1)).alias("n"))


@query("AB10 AGG13", f"WITH {CALLS} SELECT variant, round(avg((event_type = 'error')::INT), 6) AS error_rate FROM calls GROUP BY 1")
def error_rate(t):
    return calls(t).groupBy("variant").agg(F.round(stats.rate(F.col("event_type") == "error"), 6).alias("error_rate"))


@query(
    "LAT1 AGG15",
    """WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events)
       SELECT event_type, round(avg(value), 6) AS avg, count(*) AS n, max(value) FILTER (i = floor(n * 0.5)) AS p50, max(value) FILTER (i = floor(n * 0.95)) AS p95 FROM r GROUP BY 1""",
)
def latency_summary(t):
    return abtest.latency_summary(t.events, ["event_type"], "value").withColumn("avg", F.round("avg", 6))


@query(
    "LAT2",
    """WITH m AS (SELECT avg(value) FILTER (event_type = 'view') AS a, avg(value) FILTER (event_type = 'click') AS b FROM events)
       SELECT round(a / nullif(b, 0), 6) AS ratio, CASE WHEN a / b > 1 THEN 'faster' WHEN a / b < 1 THEN 'slower' ELSE 'equal' END AS verdict FROM m""",
)
def speedup(t):
    means = stats.conditional_means(t.events, "event_type", ["view", "click"], {"latency": F.col("value")})
    ratio, verdict = abtest.speedup(F.col("latency_view"), F.col("latency_click"))
    return means.select(F.round(ratio, 6).alias("ratio"), verdict.alias("verdict"))


@query(
    "LAT3 WIN3",
    """WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
       SELECT user_id, count(*) AS calls, round(avg(value), 6) AS mean FROM r WHERE rn > 5 GROUP BY 1""",
)
def warmup_excluded(t):
    warm = abtest.warm_calls(t.events, ["user_id"], ["ts", "event_id"], 5)
    return warm.groupBy("user_id").agg(F.count(F.lit(1)).alias("calls"), F.round(F.avg("value"), 6).alias("mean"))


@query(
    "LAT4",
    """SELECT event_type AS model, count(*) AS calls, round(avg(value / (value + 100.0)), 6) AS mean_prediction,
              round(avg(value), 6) AS mean_latency, min(value) AS min_latency, max(value) AS max_latency FROM events GROUP BY 1""",
)
def model_latency_table(t):
    return t.events.groupBy(F.col("event_type").alias("model")).agg(
        F.count(F.lit(1)).alias("calls"), F.round(F.avg(F.col("value") / (F.col("value") + 100.0)), 6).alias("mean_prediction"),
        F.round(F.avg("value"), 6).alias("mean_latency"), F.min("value").alias("min_latency"), F.max("value").alias("max_latency"),
    )


@query(
    "LAT5",
    r"""WITH s AS (SELECT doc_id, n_chars::DOUBLE AS a, length(regexp_replace(text, '[\t\n\x0B\f\r ]+', '', 'g'))::DOUBLE AS b FROM documents)
        SELECT doc_id, round(abs((a - b) * 100.0 / nullif(a, 0)), 6) AS pct, CASE WHEN a > b THEN 'reduction' WHEN a < b THEN 'increase' WHEN a = b AND a <> 0 THEN 'none' END AS kind FROM s""",
)
def size_changes(t):
    before = F.col("n_chars").cast("double")
    after = F.length(F.regexp_replace("text", r"[\t\n\x0B\f\r ]+", "")).cast("double")
    pct, kind = abtest.size_change(before, after)
    return t.documents.select("doc_id", F.round(pct, 6).alias("pct"), kind.alias("kind"))
