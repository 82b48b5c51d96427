"""Sinks. All writes are parallel; file size is bounded by rows per file instead of
one output task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.numeric import hash_bucket
from millrace.functions.text import csv_payload

ROWS_PER_FILE = 5_000_000


def table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the data set at `path`: running twice leaves the same rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*partition_by).parquet(path)


def label_first(df: DataFrame, path: str, label: str, features: Sequence[str]) -> None:
    """Header-less CSV with the label in column 0."""
    df.select(label, *features).write.mode("overwrite").csv(path, header=False)


def features_only(df: DataFrame, path: str, label: str) -> None:
    """Headered CSV without the label: the baseline file of a monitor."""
    df.drop(label).write.mode("overwrite").csv(path, header=True)


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def json(df: DataFrame, path: str) -> None:
    """Nested results or a metrics row as JSON lines."""
    df.write.mode("overwrite").json(path)


def report(df: DataFrame, path: str, line: str) -> None:
    """Report text; one value per line of the row's column."""
    df.select(line).write.mode("overwrite").text(path)


def statistics(stats: DataFrame, path: str) -> None:
    """Nested statistics document from (feature, mean, std, min, max) rows: one
    entry per feature column."""
    entry = F.struct(
        F.col("feature").alias("name"), F.struct("mean", "std", "min", "max").alias("numerical_statistics")
    )
    stats.agg(F.sort_array(F.collect_list(entry)).alias("features")).write.mode("overwrite").json(path)


def constraints(spark, path: str, comparison: str = "Robust", threshold: float = 0.1) -> None:
    rule = F.struct(F.lit(comparison).alias("comparison_type"), F.lit(threshold).alias("threshold"))
    doc = F.struct(rule.alias("distribution_constraints")).alias("monitoring_config")
    spark.range(1).select(doc).write.mode("overwrite").json(path)


def sampled(df: DataFrame, key: str, pct: int, seed: str = "capture") -> DataFrame:
    """Hash sample of the calls to capture; 100 keeps all."""
    return df if pct >= 100 else df.where(hash_bucket(F.col(key), 100, seed) < pct)


def captures(df: DataFrame, path: str, key: str, time: Column, features: Sequence[str], prediction: Column, pct: int = 100) -> None:
    """Calls as capture events in JSON lines, one folder per hour. Ranges of (hour,
    id) keep the file count low and still split a busy hour over tasks."""
    chosen = sampled(df, key, pct)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoding = F.lit("CSV").alias("encoding")
    chosen.select(
        F.struct(
            F.struct(csv_payload([F.col(f) for f in features]).alias("data"), encoding).alias("endpointInput"),
            F.struct(prediction.cast("string").alias("data"), encoding).alias("endpointOutput"),
        ).alias("captureData"),
        F.struct(
            F.col(key).cast("string").alias("eventId"),
            F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("inferenceTime"),
        ).alias("eventMetadata"),
        F.date_format(time, "yyyy-MM-dd-HH").alias("hour"),
    ).repartitionByRange(parts, "hour", "eventMetadata.eventId").write.mode("overwrite").partitionBy("hour").json(path)


# Ends a document in a packed file; within documents it is written as an escape.
DOCUMENT_END, _ESCAPE = "\x1e", "\x1d"


def packed_documents(df: DataFrame, path: str, key: str, text: str) -> None:
    """Whole texts as records of few large text files, whatever their number: name, line end, text, `DOCUMENT_END`. A NULL
    text is written as an empty one."""
    row = F.concat_ws("\n", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    safe = F.replace(F.replace(row, F.lit(_ESCAPE), F.lit(_ESCAPE + "A")), F.lit(DOCUMENT_END), F.lit(_ESCAPE + "B"))
    df.select(safe.alias("value")).write.mode("overwrite").option("lineSep", DOCUMENT_END).text(path)


def unescaped(record: Column) -> Column:
    """The text of a record as it was before it was packed."""
    return F.replace(F.replace(record, F.lit(_ESCAPE + "B"), F.lit(DOCUMENT_END)), F.lit(_ESCAPE + "A"), F.lit(_ESCAPE))
