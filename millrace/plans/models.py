"""Training and scoring. Fits are iterative, so most have no SQL check."""

from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.functions.numeric import hash_bucket
from millrace.operators import attribution, boosting, drift, evaluate, models as mx, prepare
from millrace.plans.registry import query

FEATURES = ["n_chars", "n_words", "avg_word", "n_lines"]


def labelled_features(t):
    """Numeric features of the labelled documents, hash-split."""
    text = F.col("text")
    words = tx.word_count(text)
    docs = t.documents.select(
        "doc_id", "lang", "n_chars", words.alias("n_words"),
        F.coalesce(F.try_divide(F.col("n_chars"), words), F.lit(0.0)).alias("avg_word"),
        F.size(F.split(text, "\n")).alias("n_lines"),
    )
    return prepare.assign_split(docs.join(t.labels, "doc_id"), "doc_id")


def vectors(t, features=FEATURES):
    return mx.assembled(labelled_features(t), features, "quality")


def _sides(t):
    df = vectors(t).select("doc_id", "label", "features", "split")
    return df.where("split = 'train'"), df.where("split = 'test'")


def _evaluated(model, name, train, test):
    both = train.unionByName(test)
    rows = mx.scored(model, both)
    m = evaluate.binary_metrics(rows, "label", "pred", by=["split"])
    return m.withColumn("model", F.lit(name))


@query("ML1 EVL1 EVL2")
def logistic_model(t):
    train, test = _sides(t)
    return _evaluated(mx.fit_logistic(train), "logistic", train, test)


@query("ML2")
def forest_model(t):
    train, test = _sides(t)
    return _evaluated(mx.fit_forest(train, trees=100, depth=10), "forest", train, test)


@query("ML3")
def boosted_model(t):
    train, test = _sides(t)
    return _evaluated(mx.fit_boosted(train, rounds=100, depth=5, eta=0.2, key="doc_id"), "boosted", train, test)


# Attributes of an order line of which each has fewer different values than a booster has bins.
LINE_FEATURES = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]
_STUMP_CELLS = " UNION ALL ".join(f"SELECT {i} AS f, {c}::DOUBLE AS v, y FROM l" for i, c in enumerate(LINE_FEATURES))


@query(
    "ML3",
    f"""WITH l AS (SELECT *, (l_returnflag = 'R')::INT AS y FROM lineitem),
        c AS (SELECT f, v, sum(0.5 - y) AS g, 0.25 * count(*) AS h FROM ({_STUMP_CELLS}) GROUP BY 1, 2),
        r AS (SELECT f, v, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY f) AS g, sum(h) OVER (PARTITION BY f) AS h FROM c WINDOW w AS (PARTITION BY f ORDER BY v)),
        s AS (SELECT *, (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) / 2 AS gain FROM r WHERE hl >= 1 AND h - hl >= 1)
        SELECT list_extract({LINE_FEATURES}, f + 1) AS feature, v AS cut, round(gain, 4) AS gain, round(-gl / (hl + 1), 6) AS left_value, round(-(g - gl) / (h - hl + 1), 6) AS right_value
        FROM s ORDER BY round(gain, 9) DESC, f, v LIMIT 1""",
)
def first_cut(t):
    # The first cut of a booster over all order lines: one tree of one level, whose every candidate SQL can weigh.
    rows = t.lineitem.select(F.array(*[F.col(c).cast("double") for c in LINE_FEATURES]).alias("features"), (F.col("l_returnflag") == "R").cast("int").alias("label"))
    tree = boosting.fit(rows, rounds=1, depth=1, eta=1.0).rounds[0][0]
    row = (LINE_FEATURES[tree.feature[0]], float(tree.cut[0]), round(float(tree.gain[0]), 4), round(float(tree.value[1]), 6), round(float(tree.value[2]), 6))
    return t.spark.createDataFrame([row], "feature string, cut double, gain double, left_value double, right_value double")


@query("ML4")
def multiclass_model(t):
    df = mx.vector_column(prepare.assign_split(t.embeddings, "vec_id"), "embedding").withColumn("label", F.col("label").cast("double"))
    model = mx.fit_multiclass(df.where("split = 'train'"), rounds=100, depth=5, key="vec_id")
    rows = mx.scored_multiclass(model, df)
    return rows.groupBy("split").agg(
        F.avg((F.col("label") == F.col("pred")).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n")
    )


# Rounds, depth and learning rate of the five named configurations.
VARIANTS = {
    "conservative": {"rounds": 25, "depth": 2, "eta": 0.3},
    "balanced": {"rounds": 50, "depth": 4, "eta": 0.2},
    "aggressive": {"rounds": 100, "depth": 6, "eta": 0.1},
    "deep": {"rounds": 50, "depth": 8, "eta": 0.2},
    "fast": {"rounds": 30, "depth": 3, "eta": 0.4},
}


@query("ML5")
def model_variants(t):
    train, test = _sides(t)
    return mx.compare_variants(train, test, VARIANTS).drop("seconds")


@query("ML6")
def batch_scores(t):
    train, test = _sides(t)
    return mx.scored(mx.fit_logistic(train), test).select("doc_id", "label", "p", "pred")


@query(
    "ML1 ML2 ML3 ML6",
    """WITH s AS (SELECT doc_id, CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM documents JOIN labels USING (doc_id))
       SELECT model, split, count(*) AS n, true AS in_range, true AS consistent FROM s, (SELECT unnest(['logistic', 'forest', 'boosted']) AS model) GROUP BY 1, 2""",
)
def fitted_model_facts(t):
    # What holds for every fit: each row is scored once, with a probability and the class it says.
    train, test = _sides(t)
    both, result = train.unionByName(test), None
    for name, model in (("logistic", mx.fit_logistic(train)), ("forest", mx.fit_forest(train, trees=100, depth=10)), ("boosted", mx.fit_boosted(train, rounds=100, depth=5, eta=0.2, key="doc_id"))):
        rows = mx.scored(model, both).groupBy("split").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.col("p").between(0, 1)).alias("in_range"), F.min((F.col("p") > 0.5).cast("int") == F.col("pred")).alias("consistent"))
        rows = rows.select(F.lit(name).alias("model"), "*")
        result = rows if result is None else result.unionByName(rows)
    return result


_CENTROIDS = """cells AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
  means AS (SELECT label, pos, avg(x) AS m FROM cells GROUP BY 1, 2)"""


@query("ML7 ARR-F5", f"WITH {_CENTROIDS} SELECT vec_id, label, round(sum(x * m), 6) AS score FROM cells JOIN means USING (label, pos) GROUP BY 1, 2")
def routed_scores(t):
    weights = mx.centroids(t.embeddings, "label", "embedding")
    return mx.routed_scores(t.embeddings, weights, "label", "embedding").select("vec_id", "label", F.round("score", 6).alias("score"))


@query("ML8")
def model_agreement(t):
    train, test = _sides(t)
    a = mx.scored(mx.fit_logistic(train), test).select("doc_id", F.col("pred").alias("pred_a"), F.col("p").alias("p_a"))
    b = mx.scored(mx.fit_forest(train, trees=100, depth=10), test).select("doc_id", F.col("pred").alias("pred_b"), F.col("p").alias("p_b"))
    return a.join(b, "doc_id").agg(
        F.avg((F.col("pred_a") == F.col("pred_b")).cast("double")).alias("agreement"),
        F.avg(F.abs(F.col("p_a") - F.col("p_b"))).alias("mean_gap"), F.count(F.lit(1)).alias("n"),
    )


@query("FEV1")
def feature_set_comparison(t):
    base = labelled_features(t).persist()
    try:
        rows = []
        for names in (FEATURES[:1], FEATURES[:3], FEATURES):
            df = mx.assembled(base, names, "quality").select("label", "features", "split")
            model = mx.fit_logistic(df.where("split = 'train'"))
            m = evaluate.binary_metrics(mx.scored(model, df.where("split = 'test'")), "label", "pred").first()
            rows.append((",".join(names), m.accuracy, m.f1_score, m.samples_evaluated))
    finally:
        base.unpersist()
    return t.spark.createDataFrame(rows, "features string, accuracy double, f1_score double, samples_evaluated bigint")


@query("DRF11")
def attribution_drift(t):
    # One model, scored again in both segments with each feature exchanged among their rows.
    segment = F.when(hash_bucket(F.col("doc_id"), 2, "window") == 0, "before").otherwise("after")
    rows = labelled_features(t).select(
        "doc_id", segment.alias("segment"), F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("features"), F.col("quality").alias("label"))
    model = mx.fit_boosted(rows, rounds=100, depth=5, eta=0.2, key="doc_id")
    importance = attribution.permutation_importance(rows, lambda df: mx.scored(model, df), FEATURES, "doc_id", ["segment"])
    return drift.rank_changes(importance, "segment", "before", "after")


_EXCHANGED = """e AS (SELECT event_id, event_type, value, json_extract_string(props, '$.k')::DOUBLE AS k, md5('0:' || event_id) AS h FROM events),
        b AS (SELECT *, ('0x' || substr(h, 1, 15))::BIGINT % ceil(count(*) OVER (PARTITION BY event_type) / 500.0)::BIGINT AS b FROM e),
        x AS (SELECT *, coalesce(lead(value) OVER w, first_value(value) OVER w) AS v2, coalesce(lead(k) OVER w, first_value(k) OVER w) AS k2
              FROM b WINDOW w AS (PARTITION BY event_type, b ORDER BY h, event_id))"""


@query(
    "DRF11",
    f"""WITH {_EXCHANGED}
        SELECT event_type, 'value' AS feature, count(*) AS n, round(avg(pow(v2 - value, 2)), 4) AS importance FROM x GROUP BY 1
        UNION ALL SELECT event_type, 'k', count(*), round(avg(pow(2 * (k2 - k), 2)), 4) FROM x GROUP BY 1""",
)
def attribution_of_a_rule(t):
    # The same for a rule known by heart, whose loss without exchange is nought: SQL follows every exchanged row.
    rule = lambda x: x[0] + 2 * x[1]
    x = F.array(F.col("value"), F.get_json_object("props", "$.k").cast("double"))
    rows = t.events.select("event_type", "event_id", x.alias("features")).withColumn("label", rule(F.col("features")))
    out = attribution.permutation_importance(
        rows, lambda df: df.withColumn("p", rule(F.col("features"))), ["value", "k"], "event_id", ["event_type"], loss=lambda p, y: F.pow(p - y, 2), bucket_rows=500)
    return out.select("event_type", "feature", "n", F.round("importance", 4).alias("importance"))


@query(
    "UDF3",
    """WITH e AS (SELECT event_type, value, json_extract_string(props, '$.k')::DOUBLE AS k FROM events)
       SELECT event_type, count(*) AS n, round(regr_intercept(value, k), 4) AS intercept, round(regr_slope(value, k), 4) AS slope FROM e GROUP BY 1""",
)
def model_per_key(t):
    rows = t.events.select("event_type", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    fitted = mx.fit_linear_by_key(rows, "event_type", ["k"], "value")
    return fitted.select("event_type", "n", F.round(F.col("weights")[0], 4).alias("intercept"), F.round(F.col("weights")[1], 4).alias("slope"))
