"""A training corpus from raw documents: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of `docs`. Repeated rows, rows without id or text and further columns are allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, language_id, near_dedup, secret_scan, sentencepiece_codec
from millrace.llm.common import whole_row
from millrace.session import written

LEAST_LANGUAGE_SCORE = 0.4
NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts of no clear language. The model learns from the
    documents that name their language."""
    model = language_id.fit(docs, F.lit(True))
    told = language_id.predict(docs, model, [whole_row(docs).alias("row")])
    clear = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return told.where(clear).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the least doc_id; of rows
    that repeat a doc_id one stays. Texts without words and rows without doc_id are linked with nothing."""
    return near_dedup.representatives(docs, NEAR_PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by its kind; n_chars follows the new text."""
    return secret_scan.without_secrets(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the piece ids of the text."""
    ids = sentencepiece_codec.encoded(docs, sentencepiece_codec.read_model(), ["doc_id", "lang", "source"])
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode_pieces),
]
ORACLE_SQL = None  # a trained classifier and a tokenizer are not expressible in SQL; see the tests


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
