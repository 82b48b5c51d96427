"""Aggregates, data quality, preparation."""

from pyspark.sql import functions as F

from millrace.functions import numeric as nx
from millrace.functions.time import period_start
from millrace.operators import prepare, quality, stats
from millrace.operators.ordered import exact_quantiles
from millrace.plans.registry import query

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LONG = """long AS (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS feature,
                          unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS v FROM lineitem)"""
DOCS = "docs AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
SPLIT = "('0x' || substr(md5('42:' || o_orderkey), 1, 8))::BIGINT % 100"


def labelled(t):
    """Documents with their labels, NULL where there is none."""
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left")


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query("AGG1", " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n_rows FROM {name}" for name in TABLES))
def table_sizes(t):
    counts = [getattr(t, n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n_rows")) for n in TABLES]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


@query(
    "AGG2 DQ1 FLT1",
    f"""WITH {DOCS}, c AS (SELECT count(*) AS n, count(*) - count(doc_id) AS doc_id, count(*) - count(lang) AS lang, count(*) - count(source) AS source,
                                  count(*) - count(n_chars) AS n_chars, count(*) - count(quality) AS quality, count(*) - count(toxic) AS toxic FROM docs)
        SELECT unnest(['doc_id', 'lang', 'source', 'n_chars', 'quality', 'toxic']) AS column_name,
               unnest([doc_id, lang, source, n_chars, quality, toxic]) AS nulls, n AS n_rows FROM c""",
)
def null_profile(t):
    joined = labelled(t)
    return quality.null_profile(joined, joined.columns)


@query("AGG3", "SELECT c_mktsegment, round(median(c_acctbal), 6) AS median FROM customer GROUP BY 1")
def exact_median(t):
    m = exact_quantiles(t.customer, ["c_mktsegment"], "c_acctbal", {"median": 0.5})
    return m.select("c_mktsegment", F.round("median", 6).alias("median"))


@query(
    "AGG4",
    """WITH c AS (SELECT 'c_mktsegment' AS feature, c_mktsegment AS v, count(*) AS n FROM customer GROUP BY 2
                  UNION ALL SELECT 'c_nationkey', c_nationkey::VARCHAR, count(*) FROM customer GROUP BY 2)
       SELECT feature, v AS mode, n FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS r FROM c) WHERE r = 1""",
)
def deterministic_mode(t):
    return stats.modes(t.customer, ["c_mktsegment", "c_nationkey"])


@query(
    "AGG5 AGG6 AGG12",
    """SELECT event_type, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high, round(sum(value), 2) AS total FROM events GROUP BY 1""",
)
def basic_aggregates(t):
    return t.events.groupBy("event_type").agg(
        F.round(F.avg("value"), 6).alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    "AGG7 AGG16",
    f"""WITH {LONG} SELECT feature, count(v) AS count, round(avg(v), 2) AS mean, round(stddev_samp(v), 2) AS std, round(min(v), 2) AS min,
               round(quantile_cont(v, 0.25), 2) AS q25, round(quantile_cont(v, 0.5), 2) AS q50, round(quantile_cont(v, 0.75), 2) AS q75, round(max(v), 2) AS max
        FROM long GROUP BY feature""",
)
def described_features(t):
    return stats.describe(t.lineitem, LINE_FEATURES)


@query("AGG8 AGG9", "SELECT event_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct FROM events GROUP BY 1")
def counts_with_share(t):
    shared = stats.with_share(stats.value_counts(t.events, ["event_type"]))
    return shared.withColumn("share_pct", F.round("share_pct", 6))


@query(
    "AGG10 AGG13",
    f"""WITH {DOCS} SELECT lang, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality = 1 AND toxic = 0) AS clean,
               round(avg(quality), 6) AS good_rate FROM docs GROUP BY 1""",
)
def conditional_counts(t):
    return labelled(t).groupBy("lang").agg(
        F.count_if(F.col("quality") == 1).alias("good"),
        F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("clean"),
        F.round(stats.rate(F.col("quality") == 1), 6).alias("good_rate"),
    )


@query(
    "AGG14",
    """SELECT lang, arg_max(doc_id, n_chars * 1000000000 - doc_id) AS longest_id, max(n_chars) AS longest,
              arg_min(doc_id, n_chars * 1000000000 + doc_id) AS shortest_id, min(n_chars) AS shortest FROM documents GROUP BY 1""",
)
def extreme_documents(t):
    rows = stats.extreme_rows(t.documents, "n_chars", "doc_id", [], by=["lang"])
    return rows.select(
        "lang", F.col("highest.doc_id").alias("longest_id"), F.col("highest.n_chars").alias("longest"),
        F.col("lowest.doc_id").alias("shortest_id"), F.col("lowest.n_chars").alias("shortest"),
    )


@query(
    "AGG15",
    """WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events)
       SELECT event_type, max(value) FILTER (i = floor(n * 0.5)) AS p50, max(value) FILTER (i = floor(n * 0.95)) AS p95 FROM r GROUP BY 1""",
)
def positional_percentiles(t):
    return exact_quantiles(t.events, ["event_type"], "value", {"p50": 0.5, "p95": 0.95}, kind="positional")


@query(
    "AGG16",
    """SELECT event_type, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.99), 6) AS p99
       FROM events GROUP BY 1""",
)
def interpolated_percentiles(t):
    q = exact_quantiles(t.events, ["event_type"], "value", {"p10": 0.1, "p90": 0.9, "p99": 0.99})
    return q.select("event_type", *[F.round(c, 6).alias(c) for c in ("p10", "p90", "p99")])


@query(
    "AGG17",
    """WITH p AS (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS b, avg(value) AS m, sum(value) AS s, count(*) AS n FROM events GROUP BY 1, 2)
       SELECT event_type, round(avg(m), 6) AS mean_of_periods, round(sum(s) / sum(n), 6) AS weighted_mean, count(*) AS periods FROM p GROUP BY 1""",
)
def means_of_periods(t):
    m = stats.two_level_mean(t.events, ["event_type"], period_start(F.col("ts"), "5 minutes"), "value")
    return m.select("event_type", F.round("mean_of_periods", 6).alias("mean_of_periods"), F.round("weighted_mean", 6).alias("weighted_mean"), "periods")


@query("AGG18 SET1", "SELECT p_brand, p_name, count(*) AS mentions FROM part GROUP BY 1, 2")
def distinct_by_type(t):
    return t.part.groupBy("p_brand", "p_name").agg(F.count(F.lit(1)).alias("mentions"))


@query(
    "AGG19",
    r"""SELECT lang, round(avg(len(regexp_extract_all(lower(text), '\p{L}+'))), 6) AS avg_terms FROM documents GROUP BY 1""",
)
def average_list_length(t):
    from millrace.functions.text import terms

    return t.documents.groupBy("lang").agg(F.round(F.avg(F.size(terms(F.col("text")))), 6).alias("avg_terms"))


@query(
    "DQ2 DQ3",
    f"""WITH {DOCS} SELECT unnest(['not_empty', 'not_null:doc_id', 'not_null:quality', 'domain:quality', 'positive_length']) AS check_name,
               unnest([CASE WHEN count(*) = 0 THEN 1 ELSE 0 END, count(*) - count(doc_id), count(*) - count(quality),
                       count(*) FILTER (quality IS NULL OR quality NOT IN (0, 1)), count(*) FILTER (NOT n_chars > 0)]) AS failures FROM docs""",
)
def failed_checks(t):
    return quality.violations(
        labelled(t), not_null=["doc_id", "quality"], domains={"quality": [0, 1]}, rules={"positive_length": F.col("n_chars") > 0}
    )


@query(
    "DQ4",
    """WITH e AS (SELECT json_extract_string(props, '$.k') AS k, event_type, json_extract_string(props, '$.none') AS none FROM events)
       SELECT unnest(['k', 'event_type', 'none']) AS column_name, unnest([avg((k IS NOT NULL)::INT), avg((event_type IS NOT NULL)::INT), avg((none IS NOT NULL)::INT)]) AS completeness,
              unnest([count(try_cast(k AS BIGINT)) / nullif(count(k), 0)::DOUBLE, count(try_cast(event_type AS BIGINT)) / nullif(count(event_type), 0)::DOUBLE,
                      count(try_cast(none AS BIGINT)) / nullif(count(none), 0)::DOUBLE]) AS type_conformance FROM e""",
)
def type_conformance(t):
    raw = t.events.select(F.get_json_object("props", "$.k").alias("k"), "event_type", F.get_json_object("props", "$.none").alias("none"))
    return quality.conformance(raw, {"k": "bigint", "event_type": "bigint", "none": "bigint"})


@query(
    "IMP1",
    """WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal, c_nationkey::DOUBLE AS nation FROM customer)
       SELECT c_custkey, round(coalesce(bal, (SELECT median(bal) FROM c)), 6) AS bal, nation FROM c""",
)
def median_imputed(t):
    known = t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"), F.col("c_nationkey").alias("nation"))
    return prepare.impute_median(known, ["bal", "nation"]).withColumn("bal", F.round("bal", 6))


@query(
    "IMP2",
    f"""WITH {DOCS}, m AS (SELECT quality AS v FROM docs WHERE quality IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT doc_id, coalesce(quality, (SELECT v FROM m)) AS quality FROM docs""",
)
def mode_imputed(t):
    return prepare.impute_mode(labelled(t).select("doc_id", "quality"), ["quality"])


@query("IMP3", f"WITH {DOCS} SELECT doc_id, coalesce(quality::DOUBLE, 28.7) AS quality, coalesce(toxic, -1) AS toxic FROM docs")
def constant_imputed(t):
    return prepare.impute_constant(labelled(t).select("doc_id", "quality", "toxic"), {"quality": 28.7, "toxic": -1})


@query(
    "ENC2",
    """WITH w AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS word FROM part),
            g AS (SELECT p_partkey, CASE WHEN word IN ('small', 'old') THEN 'Rare' WHEN word = 'hot' THEN 'red' ELSE word END AS word FROM w)
       SELECT p_partkey, CASE word WHEN 'red' THEN 1 WHEN 'blue' THEN 2 WHEN 'Rare' THEN 5 ELSE 0 END AS code FROM g""",
)
def title_codes(t):
    code = prepare.title_code(
        F.col("p_name"), {"red": 1, "blue": 2, "Rare": 5}, {"hot": "red"}, ["small", "old"],
        find=lambda name: F.substring_index(name, " ", 1),
    )
    return t.part.select("p_partkey", code.alias("code"))


@query(
    "SPL1",
    f"""SELECT CASE WHEN {SPLIT} < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum, round(avg(o_totalprice), 4) AS price
        FROM orders GROUP BY 1""",
)
def hash_split(t):
    return prepare.assign_split(t.orders, "o_orderkey").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"), F.round(F.avg("o_totalprice"), 4).alias("price")
    )


@query(
    "SPL1",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
       SELECT CASE WHEN rn <= floor(n * 80 / 100) THEN 'train' ELSE 'test' END AS split, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM r GROUP BY 1""",
)
def exact_size_split(t):
    return prepare.assign_exact_split(t.orders.select("o_orderkey"), "o_orderkey").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "SPL2",
    """SELECT label, count(*) FILTER (('0x' || substr(md5('7:' || vec_id), 1, 8))::BIGINT % 100 >= 90) AS validation, count(*) AS n FROM embeddings GROUP BY 1""",
)
def validation_holdout(t):
    parts = prepare.assign_split(t.embeddings, "vec_id", 90, 7, labels=("train", "validation"))
    return parts.groupBy("label").agg(F.count_if(F.col("split") == "validation").alias("validation"), F.count(F.lit(1)).alias("n"))


@query(
    "SPL3",
    f"""WITH s AS (SELECT o_orderkey, {SPLIT} < 80 AS train FROM orders)
        SELECT 'keyed' AS method, (SELECT count(*) FROM s a WHERE NOT train AND o_orderkey IN (SELECT o_orderkey FROM s WHERE train)) AS overlap
        UNION ALL SELECT 'none', (SELECT count(*) FROM s)""",
)
def split_leakage(t):
    parts = prepare.assign_split(t.orders.select("o_orderkey"), "o_orderkey")
    keyed = prepare.split_overlap(parts.where("split = 'train'"), parts.where("split = 'test'"), "o_orderkey")
    everything = prepare.split_overlap(parts, parts, "o_orderkey")
    return keyed.withColumn("method", F.lit("keyed")).unionByName(everything.withColumn("method", F.lit("none")))


@query(
    "EXP13",
    """SELECT doc_id, CASE WHEN ('0x' || substr(md5('flip42:' || doc_id), 1, 8))::BIGINT % 100 < 30 THEN 1 - quality ELSE quality END AS quality FROM labels""",
)
def flipped_labels(t):
    return prepare.flip_labels(t.labels.select("doc_id", "quality"), "quality", "doc_id", 30)


@query(
    "IMP1 IMP2 IMP3 ENC1 EXP4 EXP5 PRJ1 PRJ3 DQ2 DQ3 AGG3 AGG4",
    f"""WITH {DOCS}, m AS (SELECT median(CASE WHEN quality IS NOT NULL THEN n_chars END) AS chars FROM docs),
            q AS (SELECT quality AS v FROM docs WHERE quality IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT coalesce(quality, (SELECT v FROM q)) AS target, round(coalesce(CASE WHEN quality IS NOT NULL THEN n_chars END, (SELECT chars FROM m)), 4) AS chars,
               CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS lang_code, coalesce(quality, 0) + coalesce(toxic, 0) AS flags,
               CASE WHEN coalesce(quality, 0) + coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END AS unflagged, doc_id FROM docs""",
)
def prepared_training_table(t):
    """Scan, profile, impute, encode, derive, validate: the whole preparation job."""
    df = labelled(t).withColumn("chars", F.when(F.col("quality").isNotNull(), F.col("n_chars")))
    df = prepare.impute_median(df, ["chars"])
    df = df.withColumn("flags", F.coalesce("quality", F.lit(0)) + F.coalesce("toxic", F.lit(0)))
    df = prepare.impute_mode(df.withColumn("target", F.col("quality")), ["target"])
    df = df.withColumns(
        {
            "chars": F.round("chars", 4),
            "lang_code": nx.case_encode(F.col("lang"), {"en": 0, "fr": 1, "de": 2}, 3),
            "unflagged": F.when(F.col("flags") == 0, 1).otherwise(0),
        }
    )
    final = df.select("target", "chars", "lang_code", "flags", "unflagged", "doc_id")
    return quality.require(final, not_null=["target"], domains={"target": [0, 1]})
