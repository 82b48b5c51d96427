"""The plans for large tables on the given ones: the same queries and checks with limits so low
that groups are chunked, quantiles selected, and sides shuffled."""

from pyspark.sql import functions as F

from millrace.operators import documents as dx, drift, feature_store, relational
from millrace.operators.ordered import exact_quantiles
from millrace.plans import aggregates, documents, monitoring, ordering  # noqa: F401  (their checks are used here)
from millrace.plans.documents import moods
from millrace.plans.monitoring import halves
from millrace.plans.registry import ORACLES, query

ROWS = 1_000


@query("WIN2", ORACLES["version_changes"])
def version_changes_chunked(t):
    rows = feature_store.version_changes(t.events, ["user_id"], ["ts", "event_id"], "value", limit=60)
    return rows.select("event_id", "user_id", "value", "prev_value", F.round("change", 4).alias("change"))


@query("AGG15", ORACLES["positional_percentiles"])
def positional_percentiles_selected(t):
    return exact_quantiles(t.events, ["event_type"], "value", {"p50": 0.5, "p95": 0.95}, kind="positional", limit=ROWS)


@query("DRF5", ORACLES["ks_shift"])
def ks_shift_chunked(t):
    return drift.ks_shift(halves(t), ["value"], F.col("cur"), limit=ROWS).withColumn("ks", F.round("ks", 6))


@query("DOC5", ORACLES["key_phrases"])
def key_phrases_shuffled(t):
    return dx.key_phrases(t.spread("documents", "doc_id"), limit=0).withColumn("rank", F.col("rank").cast("bigint"))


@query("DOC3", ORACLES["document_sentiment"])
def document_sentiment_shuffled(t):
    return moods(t, limit=0)


@query(
    "JN4",
    "SELECT l_orderkey, l_linenumber, l_partkey, p_brand, p_size FROM lineitem LEFT JOIN part ON l_partkey = p_partkey",
)
def lookup_shuffled(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return relational.lookup_join(lines, t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size"), "l_partkey", limit=0)
