"""Projections, filters and scalar functions."""

from pyspark.sql import functions as F

from millrace.functions import numeric as nx, text as tx, time as tm
from millrace.plans.registry import query

STATUS = {"O": 0, "P": 1}


@query(
    "PRJ1 PRJ4 EXP4 EXP5",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + l_tax AS load, CASE WHEN l_tax = 0 THEN 1 ELSE 0 END AS untaxed
       FROM lineitem""",
)
def derived_features(t):
    derived = t.lineitem.withColumns(
        {"load": F.col("l_quantity") + F.col("l_tax"), "untaxed": nx.flag(F.col("l_tax") == 0)}
    )
    return derived.select("l_orderkey", "l_linenumber", "l_partkey", "load", "untaxed")


@query("PRJ2", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def dropped_columns(t):
    return t.part.drop("p_name", "p_retailprice")


@query("PRJ3", "SELECT quality, toxic, doc_id FROM labels")
def label_first_order(t):
    return t.labels.select("quality", "toxic", "doc_id")


@query("FLT2", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000 AND o_totalprice <= 450000 AND o_orderkey > 10")
def numeric_range(t):
    return t.orders.where("o_totalprice > 300000 AND o_totalprice <= 450000 AND o_orderkey > 10").select("o_orderkey", "o_totalprice")


@query("FLT4 EXP11", "SELECT c_custkey, CASE WHEN c_acctbal > 5000 OR c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS target FROM customer")
def either_rule_label(t):
    return t.customer.select("c_custkey", nx.flag((F.col("c_acctbal") > 5000) | (F.col("c_mktsegment") == "BUILDING")).alias("target"))


@query("FLT5", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY 1")
def membership_filter(t):
    return t.orders.where(F.col("o_orderstatus").isin("O", "P")).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "FLT7",
    """SELECT contains(url, 'example') AS is_example, starts_with(url, 'https') AS is_https, suffix(url, '.html') AS is_html,
              count(*) AS n FROM pages GROUP BY 1, 2, 3""",
)
def string_predicates(t):
    url = F.col("url")
    return t.pages.groupBy(
        F.contains(url, F.lit("example")).alias("is_example"), F.startswith(url, F.lit("https")).alias("is_https"),
        F.endswith(url, F.lit(".html")).alias("is_html"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "FLT8 EXP11",
    """SELECT l_returnflag, sum(CASE WHEN l_quantity > 20 AND l_extendedprice > 35000 AND l_tax < l_discount * 0.5 THEN 1 ELSE 0 END)::BIGINT AS approved,
              count(*) AS n FROM lineitem GROUP BY 1""",
)
def cross_column_rule(t):
    rule = (F.col("l_quantity") > 20) & (F.col("l_extendedprice") > 35000) & (F.col("l_tax") < F.col("l_discount") * 0.5)
    return t.lineitem.groupBy("l_returnflag").agg(F.sum(nx.flag(rule)).alias("approved"), F.count(F.lit(1)).alias("n"))


@query(
    "EXP1 EXP2 ENC1",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 END AS mapped,
              CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 ELSE 2 END AS cased,
              CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS rank
       FROM orders""",
)
def encodings(t):
    urgency = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1}
    return t.orders.select(
        "o_orderkey",
        nx.map_encode(F.col("o_orderstatus"), STATUS).alias("mapped"),
        nx.case_encode(F.col("o_orderstatus"), STATUS, 2).alias("cased"),
        nx.case_encode(F.col("o_orderpriority"), urgency, 0).alias("rank"),
    )


@query(
    "EXP3",
    """SELECT CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'VALUE' WHEN p_type IN ('LARGE', 'MEDIUM', 'SMALL') THEN 'SIZED' ELSE p_type END AS kind,
              count(*) AS n FROM part GROUP BY 1""",
)
def collapsed_synonyms(t):
    groups = {"VALUE": ["PROMO", "ECONOMY"], "SIZED": ["LARGE", "MEDIUM", "SMALL"]}
    return t.part.groupBy(nx.collapse(F.col("p_type"), groups).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "EXP6 EXP7",
    """SELECT c_custkey, least(greatest(c_acctbal, 0.0), 5000.0) AS clipped, round(c_acctbal / 255.0, 6) AS scaled FROM customer""",
)
def clipped_and_scaled(t):
    bal = F.col("c_acctbal")
    return t.customer.select("c_custkey", nx.clip(bal, 0.0, 5000.0).alias("clipped"), F.round(nx.scaled(bal, 255.0), 6).alias("scaled"))


@query(
    "EXP8 EVL7",
    """SELECT doc_id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS pred, round(CASE WHEN p > 0.5 THEN p ELSE 1 - p END, 6) AS confidence
       FROM (SELECT doc_id, n_chars / (n_chars + 500.0) AS p FROM documents)""",
)
def class_and_confidence(t):
    p = F.col("n_chars") / (F.col("n_chars") + 500.0)
    return t.documents.select("doc_id", nx.threshold_class(p).alias("pred"), F.round(nx.confidence(p), 6).alias("confidence"))


@query(
    "EXP12",
    "SELECT vec_id, CASE WHEN embedding[1]::DOUBLE + 0.5 * embedding[2]::DOUBLE > 0 THEN 1 ELSE 0 END AS target FROM embeddings",
)
def linear_score_label(t):
    wide = t.embeddings.select(
        "vec_id", F.col("embedding")[0].cast("double").alias("f1"), F.col("embedding")[1].cast("double").alias("f2")
    )
    return wide.select("vec_id", nx.flag(nx.weighted_score({"f1": 1.0, "f2": 0.5}) > 0).alias("target"))


@query(
    "STR-F1",
    r"""SELECT p_partkey, nullif(regexp_extract(' ' || p_name || '.', ' ([A-Za-z]+)\.', 1), '') AS word,
              nullif(regexp_extract(p_name, ' ([A-Za-z]+)\.', 1), '') AS title FROM part""",
)
def captured_title(t):
    name = F.col("p_name")
    return t.part.select("p_partkey", tx.title_of(F.concat(F.lit(" "), name, F.lit("."))).alias("word"), tx.title_of(name).alias("title"))


@query(
    "STR-F2 FLT7",
    r"""SELECT page_id, regexp_replace(url, '\.[^.]*$', '') AS stem, split_part(url, '/', -1) AS last_part,
              nullif(regexp_extract(split_part(url, '/', -1), '\.([^.]*)$', 1), '') AS suffix FROM pages""",
)
def path_parts(t):
    url = F.col("url")
    return t.pages.select("page_id", tx.strip_extension(url).alias("stem"), tx.basename(url).alias("last_part"), tx.extension(url).alias("suffix"))


@query(
    "STR-F3 STR-F4 DOC1",
    r"""SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[\t\n\x0B\f\r\x1c-\x1f\x85\p{Z}]+'), lambda w: w <> '')) AS words,
              length(text) AS characters FROM documents""",
)
def word_counts(t):
    text = F.col("text")
    return t.documents.select("doc_id", tx.word_count(text).cast("bigint").alias("words"), F.length(text).cast("bigint").alias("characters"))


@query(
    "STR-F5 DOC2",
    """WITH p AS (SELECT doc_id, text, unnest(generate_series(0, greatest(ceil(length(text) / 5000.0)::BIGINT, 1) - 1)) AS piece FROM documents)
       SELECT doc_id, piece, length(substr(text, piece * 5000 + 1, 5000)) AS characters, md5(substr(text, piece * 5000 + 1, 5000)) AS digest FROM p""",
)
def limited_pieces(t):
    from millrace.operators import documents

    return documents.pieces(t.documents).select(
        "doc_id", F.col("piece").cast("bigint").alias("piece"), F.length("text").cast("bigint").alias("characters"), F.md5("text").alias("digest")
    )


@query(
    "STR-F6 STR-F7",
    """SELECT event_id, try_cast(trim('[' || value || ']', '[]') AS DOUBLE) AS parsed, value AS first_part, user_id::DOUBLE AS second_part FROM events""",
)
def payload_round_trip(t):
    payload = tx.csv_payload([F.col("value"), F.col("user_id")])
    parts = tx.parse_payload(payload, ["first_part", "second_part"])
    return t.events.select(
        "event_id", tx.parse_score(F.concat(F.lit("["), F.col("value").cast("string"), F.lit("]"))).alias("parsed"), parts.alias("p")
    ).select("event_id", "parsed", "p.*")


@query(
    "STR-F8 STR-F9",
    """SELECT c_custkey, regexp_replace(c_name, '^Customer#', '') AS code, rpad(c_mktsegment, 12, '.') AS padded, lpad(c_custkey::VARCHAR, 8, '0') AS fixed,
              replace(lower(c_name), '#', '_') AS table_like, printf('%.2f%%', c_acctbal) AS pct, format('{:,}', c_custkey * 1000) AS thousands
       FROM customer""",
)
def formatted_text(t):
    return t.customer.select(
        "c_custkey",
        F.regexp_replace("c_name", "^Customer#", "").alias("code"),
        F.rpad("c_mktsegment", 12, ".").alias("padded"),
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("fixed"),
        F.translate(F.lower("c_name"), "#", "_").alias("table_like"),
        F.format_string("%.2f%%", "c_acctbal").alias("pct"),
        F.format_number(F.col("c_custkey") * 1000, 0).alias("thousands"),
    )


@query(
    "DT-F1 DT-F2 DT-F4 DT-F5",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%H:%M') AS clock, epoch_us(ts) AS us,
              round((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000000.0, 6) AS seconds,
              epoch_us(ts - INTERVAL 30 MINUTE) AS earlier_us FROM events""",
)
def time_functions(t):
    ts = F.col("ts")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return t.events.select(
        "event_id", tm.iso(ts).alias("iso"), tm.clock_label(ts).alias("clock"),
        tm.micros(tm.from_epoch(tm.to_epoch(ts))).alias("us"),
        F.round(tm.seconds_between(start, ts), 6).alias("seconds"),
        tm.micros(ts - F.expr("INTERVAL 30 MINUTES")).alias("earlier_us"),
    )


@query(
    "MTH-F1 MTH-F2 EXP14",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / nullif(l_tax, 0), 4) AS ratio, abs(round(l_discount - l_tax, 2)) AS gap,
              round((l_tax - l_discount) * 100.0 / nullif(l_discount, 0), 4) AS change_pct, l_quantity * 1000.0 AS ms, l_extendedprice / 1024.0 AS kb
       FROM lineitem""",
)
def guarded_arithmetic(t):
    d, x = F.col("l_discount"), F.col("l_tax")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(nx.safe_ratio(F.col("l_extendedprice"), x), 4).alias("ratio"), F.abs(F.round(d - x, 2)).alias("gap"),
        F.round(nx.change_pct(d, x), 4).alias("change_pct"), nx.millis(F.col("l_quantity")).alias("ms"),
        nx.kilobytes(F.col("l_extendedprice")).alias("kb"),
    )


@query(
    "ARR-F1 ARR-F2 ARR-F3 ARR-F4 SRT5 EXP7",
    """SELECT vec_id, len(embedding) AS width, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE / 255.0)), 6) AS scaled_sum,
              round(list_sum(list_transform(embedding[1:10], lambda x: x::DOUBLE)), 6) AS first_ten,
              len(list_distinct(list_transform(embedding, lambda x: x > 0))) AS signs
       FROM embeddings""",
)
def array_functions(t):
    v = F.col("embedding")
    # 64 values as an 8 x 8 grid and back.
    grid = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice(v, i * 8 + 1, 8))
    flat = F.flatten(grid)

    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)

    scaled = F.transform(flat, lambda x: x.cast("double") / 255.0)
    return t.embeddings.select(
        "vec_id", F.size(flat).cast("bigint").alias("width"), F.round(total(scaled), 6).alias("scaled_sum"),
        F.round(total(F.transform(F.slice(v, 1, 10), lambda x: x.cast("double"))), 6).alias("first_ten"),
        F.size(F.array_distinct(F.transform(v, lambda x: x > 0))).cast("bigint").alias("signs"),
    )


@query(
    "MAP-F1 EXP10",
    "SELECT c_custkey AS user_id, c_mktsegment AS tier, c_acctbal AS balance FROM customer",
)
def records_decoded(t):
    from millrace.operators.feature_store import FeatureGroup, decode_records

    group = FeatureGroup(
        "users", "user_id", "event_time",
        {"user_id": "Integral", "tier": "String", "balance": "Fractional", "event_time": "Fractional"},
    )
    named = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("tier"), F.col("c_acctbal").alias("balance"), F.lit(0.0).alias("event_time")
    )
    encoded = named.select(tx.to_records(list(group.features)).alias("records"))
    return decode_records(encoded, "records", group).select("user_id", "tier", "balance")


@query(
    "JSON-F1 EXP9",
    """SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), -1) AS k,
              coalesce(try_cast(json_extract_string(props, '$.missing') AS BIGINT), 0) AS absent FROM events""",
)
def json_defaults(t):
    props = F.col("props")
    return t.events.select("event_id", tx.json_field(props, "$.k", "bigint", -1).alias("k"), tx.json_field(props, "$.missing", "bigint", 0).alias("absent"))
