"""Drift, quality monitors, evaluation."""

from pyspark.sql import functions as F

from millrace.functions.time import micros, period_start
from millrace.operators import drift, evaluate, prepare, quality, stats
from millrace.operators.ordered import rank_auc
from millrace.plans.registry import query

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LONG = """long AS (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS feature,
                          unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS v, l_shipdate >= TIMESTAMP '1998-01-01' AS cur FROM lineitem)"""
HALVES = "h AS (SELECT *, ts >= TIMESTAMP '2024-01-16' AS cur FROM events)"
SCORED = """scored AS (SELECT l.doc_id, d.lang, d.source, d.n_chars, l.quality AS y, round(d.n_chars / (d.n_chars + 500.0), 2) AS p,
                             CASE WHEN round(d.n_chars / (d.n_chars + 500.0), 2) > 0.6 THEN 1 ELSE 0 END AS pred FROM labels l JOIN documents d USING (doc_id))"""
CELLS = """sum((y = 1 AND pred = 1)::INT)::DOUBLE AS tp, sum((y = 0 AND pred = 0)::INT)::DOUBLE AS tn,
           sum((y = 0 AND pred = 1)::INT)::DOUBLE AS fp, sum((y = 1 AND pred = 0)::INT)::DOUBLE AS fn"""


def later_lines(t):
    return t.lineitem.select(*LINE_FEATURES, (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")).alias("cur"))


def halves(t):
    return t.events.withColumn("cur", F.col("ts") >= F.lit("2024-01-16").cast("timestamp"))


def scored(t):
    """Labelled documents with a score from their length and its class."""
    p = F.round(F.col("n_chars") / (F.col("n_chars") + 500.0), 2)
    docs = t.documents.select("doc_id", "lang", "source", "n_chars", p.alias("p"))
    return docs.join(t.labels, "doc_id").select(
        "doc_id", "lang", "source", "n_chars", F.col("quality").alias("y"), "p", (F.col("p") > 0.6).cast("int").alias("pred")
    )


@query(
    "DRF1 DRF2 DQ4",
    """SELECT unnest(['l_quantity', 'l_extendedprice', 'l_returnflag']) AS feature, unnest(['double', 'double', 'double']) AS declared_type,
              unnest([avg((l_quantity IS NOT NULL)::INT), avg((l_extendedprice IS NOT NULL)::INT), avg((l_returnflag IS NOT NULL)::INT)]) AS completeness,
              unnest([count(try_cast(l_quantity AS DOUBLE)) / count(l_quantity)::DOUBLE, count(try_cast(l_extendedprice AS DOUBLE)) / count(l_extendedprice)::DOUBLE,
                      count(try_cast(l_returnflag AS DOUBLE)) / count(l_returnflag)::DOUBLE]) AS type_conformance,
              'Robust' AS comparison_type, 0.1::DOUBLE AS threshold FROM lineitem""",
)
def baseline_constraints(t):
    return drift.baseline_constraints(t.lineitem, {"l_quantity": "double", "l_extendedprice": "double", "l_returnflag": "double"})


@query(
    "DRF3 JN7 EXP14",
    f"""WITH {LONG}, m AS (SELECT feature, avg(v) FILTER (NOT cur) AS baseline, avg(v) FILTER (cur) AS current FROM long GROUP BY 1)
        SELECT feature, round(baseline, 4) AS baseline, round(current, 4) AS current, round((current - baseline) * 100.0 / nullif(baseline, 0), 4) AS change_pct,
               CASE WHEN nullif(baseline, 0) IS NULL THEN 'N/A' WHEN abs((current - baseline) * 100.0 / baseline) > 0.1 THEN 'DRIFT' ELSE 'OK' END AS status FROM m""",
)
def mean_shift(t):
    lines = later_lines(t)
    rows = drift.mean_shift_of_segments(lines, LINE_FEATURES, F.col("cur"), threshold=0.1)
    return rows.withColumns({c: F.round(c, 4) for c in ("baseline", "current", "change_pct")})


@query(
    "DRF4",
    f"""WITH {LONG}, q AS (SELECT feature, list_transform([1,2,3,4,5,6,7,8,9], lambda i: quantile_cont(v, 0.5)) AS dummy, quantile_cont(v, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges FROM long WHERE NOT cur GROUP BY 1),
             b AS (SELECT l.feature, len(list_filter(edges, lambda e: e < v)) AS bin, cur FROM long l JOIN q USING (feature)),
             c AS (SELECT feature, bin, count(*) FILTER (NOT cur) AS b, count(*) FILTER (cur) AS c FROM b GROUP BY 1, 2),
             n AS (SELECT feature, sum(b) AS nb, sum(c) AS nc FROM c GROUP BY 1),
             f AS (SELECT feature, unnest(generate_series(0, 9)) AS bin FROM q),
             s AS (SELECT f.feature, greatest(coalesce(b / nb, 0), 0.0001) AS b, greatest(coalesce(c / nc, 0), 0.0001) AS c
                   FROM f JOIN n USING (feature) LEFT JOIN c ON c.feature = f.feature AND c.bin = f.bin)
        SELECT feature, round(sum((c - b) * ln(c / b)), 6) AS psi FROM s GROUP BY 1""",
)
def stability_index(t):
    return drift.stability_index(later_lines(t), LINE_FEATURES, F.col("cur")).withColumn("psi", F.round("psi", 6))


@query(
    "DRF5",
    f"""WITH {HALVES}, v AS (SELECT value, count(*) FILTER (NOT cur) AS b, count(*) FILTER (cur) AS c FROM h GROUP BY 1),
             r AS (SELECT sum(b) OVER w AS fb, sum(c) OVER w AS fc FROM v WINDOW w AS (ORDER BY value)), n AS (SELECT sum(b) AS nb, sum(c) AS nc FROM v)
        SELECT 'value' AS feature, round(max(abs(fb / nb::DOUBLE - fc / nc::DOUBLE)), 6) AS ks, max(nb)::BIGINT AS n_baseline, max(nc)::BIGINT AS n_current FROM r, n""",
)
def ks_shift(t):
    return drift.ks_shift(halves(t), ["value"], F.col("cur")).withColumn("ks", F.round("ks", 6))


@query(
    "DRF6 SET4",
    f"""WITH {HALVES}, s AS (SELECT cur, value / (value + 50.0) AS p FROM h),
             m AS (SELECT avg(p) FILTER (NOT cur) AS mean_normal, avg(p) FILTER (cur) AS mean_drifted,
                          avg((p > 0.5)::INT) FILTER (NOT cur) AS rate_normal, avg((p > 0.5)::INT) FILTER (cur) AS rate_drifted FROM s)
        SELECT round(mean_normal, 6) AS mean_normal, round(mean_drifted, 6) AS mean_drifted, round(rate_normal, 6) AS rate_normal, round(rate_drifted, 6) AS rate_drifted,
               round((mean_drifted - mean_normal) * 100.0 / mean_normal, 4) AS mean_change_pct, round((rate_drifted - rate_normal) * 100.0 / rate_normal, 4) AS rate_change_pct FROM m""",
)
def prediction_drift(t):
    rows = halves(t).select(
        F.when(F.col("cur"), "drifted").otherwise("normal").alias("segment"), (F.col("value") / (F.col("value") + 50.0)).alias("p")
    )
    out = drift.prediction_drift(rows, "segment", "p", "normal", "drifted")
    return out.select(*[F.round(c, 4 if c.endswith("pct") else 6).alias(c) for c in out.columns])


@query(
    "DRF7",
    f"""WITH {LONG}, m AS (SELECT feature, avg(v) FILTER (NOT cur) AS b, avg(v) FILTER (cur) AS c, avg((v IS NOT NULL)::INT) AS full_share FROM long GROUP BY 1),
             v AS (SELECT feature, v, count(*) FILTER (NOT cur) AS b, count(*) FILTER (cur) AS c FROM long GROUP BY 1, 2),
             r AS (SELECT feature, sum(b) OVER w AS fb, sum(c) OVER w AS fc, sum(b) OVER (PARTITION BY feature) AS nb, sum(c) OVER (PARTITION BY feature) AS nc
                   FROM v WINDOW w AS (PARTITION BY feature ORDER BY v)),
             k AS (SELECT feature, max(abs(fb / nb::DOUBLE - fc / nc::DOUBLE)) AS ks FROM r GROUP BY 1),
             x AS (SELECT feature, quantile_cont(v, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges FROM long WHERE NOT cur GROUP BY 1),
             xb AS (SELECT l.feature, len(list_filter(edges, lambda e: e < v)) AS bin, cur FROM long l JOIN x USING (feature)),
             xc AS (SELECT feature, bin, count(*) FILTER (NOT cur) AS b, count(*) FILTER (cur) AS c FROM xb GROUP BY 1, 2),
             xn AS (SELECT feature, sum(b) AS nb, sum(c) AS nc FROM xc GROUP BY 1),
             xf AS (SELECT feature, unnest(generate_series(0, 9)) AS bin FROM x),
             xs AS (SELECT xf.feature, greatest(coalesce(b / nb, 0), 0.0001) AS b, greatest(coalesce(c / nc, 0), 0.0001) AS c
                    FROM xf JOIN xn USING (feature) LEFT JOIN xc ON xc.feature = xf.feature AND xc.bin = xf.bin),
             xp AS (SELECT feature, sum((c - b) * ln(c / b)) AS psi FROM xs GROUP BY 1)
        SELECT feature, 'mean_shift' AS check_name, round(b, 4) AS baseline, round(c, 4) AS current,
               CASE WHEN abs((c - b) * 100.0 / b) > 0.1 THEN 'alert' ELSE 'ok' END AS severity FROM m
        UNION ALL SELECT feature, 'completeness', 1.0, round(full_share, 4), CASE WHEN full_share < 1 THEN 'alert' ELSE 'ok' END FROM m
        UNION ALL SELECT feature, 'psi', 0.001, round(psi, 4), CASE WHEN psi > 0.001 THEN 'alert' ELSE 'ok' END FROM xp
        UNION ALL SELECT feature, 'ks', 0.005, round(ks, 4), CASE WHEN ks > 0.005 THEN 'alert' ELSE 'ok' END FROM k""",
)
def violation_report(t):
    return _report(t).withColumns({c: F.round(c, 4) for c in ("baseline", "current")})


def _report(t):
    lines = later_lines(t)
    return drift.violation_report(
        shift=drift.mean_shift_of_segments(lines, LINE_FEATURES, F.col("cur"), threshold=0.1),
        psi=drift.stability_index(lines, LINE_FEATURES, F.col("cur")),
        ks=drift.ks_shift(lines, LINE_FEATURES, F.col("cur")),
        conformance=quality.conformance(lines, {c: "double" for c in LINE_FEATURES}),
        psi_limit=0.001,
        ks_limit=0.005,
    )


@query(
    "DRF14",
    f"""WITH {LONG}, m AS (SELECT feature, avg(v) FILTER (NOT cur) AS b, avg(v) FILTER (cur) AS c FROM long GROUP BY 1),
             v AS (SELECT feature, v, count(*) FILTER (NOT cur) AS b, count(*) FILTER (cur) AS c FROM long GROUP BY 1, 2),
             r AS (SELECT feature, sum(b) OVER w AS fb, sum(c) OVER w AS fc, sum(b) OVER (PARTITION BY feature) AS nb, sum(c) OVER (PARTITION BY feature) AS nc
                   FROM v WINDOW w AS (PARTITION BY feature ORDER BY v)),
             k AS (SELECT feature, max(abs(fb / nb::DOUBLE - fc / nc::DOUBLE)) AS ks FROM r GROUP BY 1),
             x AS (SELECT feature, quantile_cont(v, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges FROM long WHERE NOT cur GROUP BY 1),
             xb AS (SELECT l.feature, len(list_filter(edges, lambda e: e < v)) AS bin, cur FROM long l JOIN x USING (feature)),
             xc AS (SELECT feature, bin, count(*) FILTER (NOT cur) AS b, count(*) FILTER (cur) AS c FROM xb GROUP BY 1, 2),
             xn AS (SELECT feature, sum(b) AS nb, sum(c) AS nc FROM xc GROUP BY 1),
             xf AS (SELECT feature, unnest(generate_series(0, 9)) AS bin FROM x),
             xs AS (SELECT xf.feature, greatest(coalesce(b / nb, 0), 0.0001) AS b, greatest(coalesce(c / nc, 0), 0.0001) AS c
                    FROM xf JOIN xn USING (feature) LEFT JOIN xc ON xc.feature = xf.feature AND xc.bin = xf.bin),
             xp AS (SELECT feature, sum((c - b) * ln(c / b)) AS psi FROM xs GROUP BY 1),
             hit AS (SELECT abs((c - b) * 100.0 / b) > 0.1 OR ks > 0.005 OR psi > 0.001 AS drifted FROM m JOIN k USING (feature) JOIN xp USING (feature))
        SELECT count(*) FILTER (drifted) AS drifted_features, count(*) FILTER (drifted) >= 2 AS retrain FROM hit""",
)
def retrain_decision(t):
    return drift.retrain_decision(_report(t), min_features=2)


@query(
    "DRF8 DRF13",
    """WITH base AS (SELECT avg(value) AS m FROM events)
       SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_rows, count(*) - count(value) AS missing,
              count(*) FILTER (try_cast(json_extract_string(props, '$.k') AS BIGINT) IS NULL) AS type_failures, round(avg(value), 6) AS mean,
              round((avg(value) - any_value(m)) * 100.0 / any_value(m), 4) AS change_pct, abs((avg(value) - any_value(m)) * 100.0 / any_value(m)) > 5 AS alert
       FROM events, base GROUP BY 1""",
)
def daily_quality_monitor(t):
    events = t.events.withColumn("k", F.get_json_object("props", "$.k"))
    base = t.events.agg(F.avg("value")).scalar()
    rows = drift.quality_by_period(events, F.date_format("ts", "yyyy-MM-dd"), "value", "k", "bigint", base, threshold=5.0)
    return rows.withColumnRenamed("period", "day").withColumns({"mean": F.round("mean", 6), "change_pct": F.round("change_pct", 4)})


@query(
    "DRF13 DT-F2",
    """SELECT 'hour' AS schedule, epoch_us(date_trunc('hour', ts)) AS start_us, count(*) AS captured FROM events GROUP BY 2
       UNION ALL SELECT 'day', epoch_us(date_trunc('day', ts)), count(*) FROM events GROUP BY 2
       UNION ALL SELECT 'week', epoch_us(date_trunc('week', ts)), count(*) FROM events GROUP BY 2""",
)
def scheduled_monitor(t):
    ts = F.col("ts")
    # Weeks start on Monday: four days after the epoch's Thursday.
    periods = {"hour": period_start(ts, "1 hour"), "day": period_start(ts, "1 day"), "week": period_start(ts, "7 days", "4 days")}
    parts = [
        drift.capture_counts(t.events, micros(p)).select(F.lit(name).alias("schedule"), F.col("period").alias("start_us"), "captured")
        for name, p in periods.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "DRF9",
    f"""WITH {SCORED}, w AS (SELECT source, {CELLS} FROM scored GROUP BY 1)
        SELECT source, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision_score,
               round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall_score, (tp + tn) / (tp + tn + fp + fn) < (SELECT avg((y = pred)::INT) FROM scored) - 0.05 AS degraded FROM w""",
)
def model_quality_monitor(t):
    rows = scored(t)
    base = rows.agg(F.avg((F.col("y") == F.col("pred")).cast("double"))).scalar()
    m = evaluate.binary_metrics(rows, "y", "pred", by=["source"])
    return m.select(
        "source", F.round("accuracy", 6).alias("accuracy"), F.round("precision", 6).alias("precision_score"),
        F.round("recall", 6).alias("recall_score"), (F.col("accuracy") < base - 0.05).alias("degraded"),
    )


_DAILY = """d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, (value > 50)::INT AS y, (json_extract_string(props, '$.k')::INT >= 50)::INT AS pred FROM events)"""


@query(
    "DRF9 DRF13",
    f"""WITH {_DAILY}, w AS (SELECT day, {CELLS} FROM d GROUP BY 1)
        SELECT day, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision_score,
               round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall_score, (tp + tn) / (tp + tn + fp + fn) < (SELECT avg((y = pred)::INT) FROM d) - 0.02 AS degraded FROM w""",
)
def daily_model_quality(t):
    k = F.get_json_object("props", "$.k").cast("int")
    rows = t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), (F.col("value") > 50).cast("int").alias("y"), (k >= 50).cast("int").alias("pred"))
    base = rows.agg(F.avg((F.col("y") == F.col("pred")).cast("double"))).scalar()
    m = evaluate.binary_metrics(rows, "y", "pred", by=["day"])
    return m.select(
        "day", F.round("accuracy", 6).alias("accuracy"), F.round("precision", 6).alias("precision_score"),
        F.round("recall", 6).alias("recall_score"), (F.col("accuracy") < base - 0.02).alias("degraded"),
    )


_PERIODS = {"hour": ("1 hour", None), "day": ("1 day", None), "week": ("7 days", "4 days")}


@query(
    "DRF13 DRF8",
    "WITH base AS (SELECT avg(value) AS m FROM events) " + " UNION ALL ".join(
        f"""SELECT '{name}' AS schedule, epoch_us(date_trunc('{name}', ts)) AS start_us, count(*) AS n_rows, count(*) - count(value) AS missing,
            count(*) FILTER (try_cast(json_extract_string(props, '$.k') AS BIGINT) IS NULL) AS type_failures, round(avg(value), 6) AS mean,
            round((avg(value) - any_value(m)) * 100.0 / any_value(m), 4) AS change_pct, abs((avg(value) - any_value(m)) * 100.0 / any_value(m)) > 5 AS alert
            FROM events, base GROUP BY 2""" for name in _PERIODS),
)
def scheduled_quality(t):
    # The same monitor on three schedules; weeks start on Monday.
    events = t.events.withColumn("k", F.get_json_object("props", "$.k"))
    base = t.events.agg(F.avg("value")).scalar()
    result = None
    for name, (length, start) in _PERIODS.items():
        at = period_start(F.col("ts"), length, *([start] if start else []))
        rows = drift.quality_by_period(events, micros(at), "value", "k", "bigint", base, threshold=5.0).withColumnRenamed("period", "start_us")
        rows = rows.select(F.lit(name).alias("schedule"), *rows.columns).withColumns({"mean": F.round("mean", 6), "change_pct": F.round("change_pct", 4)})
        result = rows if result is None else result.unionByName(rows)
    return result


@query(
    "DRF10",
    f"""WITH {SCORED}, g AS (SELECT lang, {CELLS} FROM scored GROUP BY 1)
        SELECT lang, round((tp + fp) / (tp + fp + tn + fn), 6) AS positive_rate, round(tp / nullif(tp + fn, 0), 6) AS tpr, round(fp / nullif(fp + tn, 0), 6) AS fpr FROM g""",
)
def group_bias(t):
    rows = evaluate.group_bias(scored(t), "lang", "y", "pred")
    return rows.withColumns({c: F.round(c, 6) for c in ("positive_rate", "tpr", "fpr")})


@query(
    "DRF10",
    f"""WITH {SCORED}, g AS (SELECT lang, {CELLS} FROM scored GROUP BY 1),
             r AS (SELECT (tp + fp) / (tp + fp + tn + fn) AS pr, tp / nullif(tp + fn, 0) AS tpr, fp / nullif(fp + tn, 0) AS fpr FROM g)
        SELECT round(max(pr) - min(pr), 6) AS demographic_parity_gap, round(greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)), 6) AS equalized_odds_gap FROM r""",
)
def bias_gaps(t):
    rows = evaluate.bias_gaps(scored(t), "lang", "y", "pred")
    return rows.select(*[F.round(c, 6).alias(c) for c in rows.columns])


@query(
    "DRF12",
    "SELECT epoch_us(date_trunc('hour', ts)) AS hour_us, event_type, count(*) AS captured FROM events GROUP BY 1, 2",
)
def hourly_captures(t):
    return t.events.groupBy(micros(period_start(F.col("ts"), "1 hour")).alias("hour_us"), "event_type").agg(F.count(F.lit(1)).alias("captured"))


# ---------------------------------------------------------------- evaluation


@query("EVL1 EXP8", f"WITH {SCORED} SELECT round(avg((y = pred)::INT), 6) AS accuracy, count(*) AS n FROM scored")
def accuracy(t):
    return scored(t).agg(F.round(F.avg((F.col("y") == F.col("pred")).cast("double")), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@query(
    "EVL2 EVL7",
    f"""WITH {SCORED}, c AS (SELECT {CELLS} FROM scored)
        SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision_score,
               round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall_score, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score,
               (tp + tn + fp + fn)::BIGINT AS samples_evaluated FROM c""",
)
def binary_metrics(t):
    m = evaluate.binary_metrics(scored(t), "y", "pred")
    return m.select(
        F.round("accuracy", 6).alias("accuracy"), F.round("precision", 6).alias("precision_score"),
        F.round("recall", 6).alias("recall_score"), F.round("f1_score", 6).alias("f1_score"), "samples_evaluated",
    )


@query("EVL3", f"WITH {SCORED} SELECT y AS actual, pred AS predicted, count(*) AS n FROM scored GROUP BY 1, 2")
def confusion_matrix(t):
    return evaluate.confusion(scored(t), "y", "pred")


@query(
    "EVL4",
    f"""WITH {SCORED}, k AS (SELECT unnest([0, 1]) AS c),
             s AS (SELECT c, sum((y = c)::INT)::DOUBLE AS support, sum((pred = c)::INT)::DOUBLE AS predicted, sum((y = c AND pred = c)::INT)::DOUBLE AS hit FROM scored, k GROUP BY 1),
             m AS (SELECT c::VARCHAR AS class, coalesce(hit / nullif(predicted, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r,
                          coalesce(2 * hit / nullif(predicted + support, 0), 0) AS f, support FROM s)
        SELECT class, round(p, 6) AS precision_score, round(r, 6) AS recall_score, round(f, 6) AS f1_score, support::BIGINT AS support FROM m
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::BIGINT FROM m
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM m""",
)
def classification_report(t):
    r = evaluate.classification_report(scored(t), "y", "pred")
    return r.select(
        "class", F.round("precision", 6).alias("precision_score"), F.round("recall", 6).alias("recall_score"),
        F.round("f1_score", 6).alias("f1_score"), "support",
    )


@query(
    "EVL5",
    f"""WITH {SCORED}, v AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY 1),
             r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY p) AS upto FROM v)
        SELECT round(sum(pos * (upto - neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc, sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives FROM r""",
)
def area_under_curve(t):
    return rank_auc(scored(t), [], "p", "y").withColumn("auc", F.round("auc", 6))


@query(
    "EVL6 SPL1",
    f"""WITH {SCORED}, s AS (SELECT y, pred, ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 100 < 80 AS train FROM scored),
             a AS (SELECT avg((y = pred)::INT) FILTER (train) AS tr, avg((y = pred)::INT) FILTER (NOT train) AS te FROM s)
        SELECT round(tr, 6) AS train_accuracy, round(te, 6) AS test_accuracy, round(tr - te, 6) AS gap FROM a""",
)
def overfit_gap(t):
    rows = evaluate.overfit_gap(prepare.assign_split(scored(t), "doc_id"), "y", "pred")
    return rows.select(*[F.round(c, 6).alias(c) for c in rows.columns])


@query(
    "EVL8",
    f"""WITH {SCORED}, a AS (SELECT lang, avg((y = pred)::INT) AS acc FROM scored GROUP BY 1) SELECT lang, round(acc, 6) AS accuracy, acc >= 0.75 AS passed FROM a""",
)
def quality_gate(t):
    m = evaluate.binary_metrics(scored(t), "y", "pred", by=["lang"])
    return evaluate.quality_gate(m).select("lang", F.round("accuracy", 6).alias("accuracy"), "passed")
