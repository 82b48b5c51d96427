"""Scans. Schemas are declared, never inferred, so no job runs before the query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.text import basename, parse_payload, parse_score
from millrace.sources import writers

# The nested layouts of the documents and capture files.
STATISTICS = "features array<struct<name:string,numerical_statistics:struct<mean:double,std:double,min:double,max:double>>>"
CONSTRAINTS = "monitoring_config struct<distribution_constraints:struct<comparison_type:string,threshold:double>>"
CAPTURE = (
    "captureData struct<endpointInput:struct<data:string,encoding:string>,"
    "endpointOutput:struct<data:string,encoding:string>>,"
    "eventMetadata struct<eventId:string,inferenceTime:string>"
)


def csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=header)


def label_first(spark: SparkSession, path: str, label: str, features: Sequence[str], kind: str = "double") -> DataFrame:
    """Header-less positional matrix: label in column 0, then the features."""
    schema = ", ".join(f"`{c}` {kind}" for c in [label, *features])
    return csv(spark, path, schema, header=False)


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def documents(spark: SparkSession, path: str, suffix: str = "*.txt") -> DataFrame:
    """(document, text): one row per UTF-8 file."""
    files = spark.read.option("pathGlobFilter", suffix).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("document"), F.col("value").alias("text"))


def packed_documents(spark: SparkSession, path: str) -> DataFrame:
    """(document, text): the whole texts that `writers.packed_documents` wrote; a large file is read by many tasks."""
    record = writers.unescaped(F.col("value"))
    files = spark.read.text(path, lineSep=writers.DOCUMENT_END)
    return files.select(F.substring_index(record, "\n", 1).alias("document"), F.substr(record, F.locate("\n", record) + 1).alias("text"))


def listing(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """(path, name, size_bytes, modified) of the files below a prefix; contents are
    not read, directories are not listed."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path", basename(F.col("path")).alias("name"), F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
    )


def statistics(spark: SparkSession, path: str) -> DataFrame:
    """(feature, mean, std, min, max) rows of a nested statistics document."""
    doc = spark.read.schema(STATISTICS).json(path, multiLine=True)
    return doc.select(F.explode("features").alias("f")).select(F.col("f.name").alias("feature"), "f.numerical_statistics.*")


def constraints(spark: SparkSession, path: str) -> DataFrame:
    doc = spark.read.schema(CONSTRAINTS).json(path, multiLine=True)
    return doc.select("monitoring_config.distribution_constraints.*")


def captures(spark: SparkSession, path: str, features: Sequence[str]) -> DataFrame:
    """Captured calls: id, time, features decoded from the CSV payload, prediction.
    A payload value that is no number is NULL; `bad_payload` tells such rows."""
    raw = spark.read.schema(CAPTURE).json(path)
    data = F.col("captureData.endpointInput.data")
    decoded = raw.select(
        F.col("eventMetadata.eventId").alias("event_id"),
        F.to_timestamp("eventMetadata.inferenceTime").alias("inference_time"),
        parse_payload(data, features).alias("_f"),
        parse_score(F.col("captureData.endpointOutput.data")).alias("prediction"),
    ).select("event_id", "inference_time", "_f.*", "prediction")
    missing = F.lit(False)
    for f in features:
        missing = missing | F.col(f).isNull()
    return decoded.withColumn("bad_payload", missing)


def metric_scan(df: DataFrame, time: str, start: Column, end: Column, dimensions: Mapping[str, object] | None = None) -> DataFrame:
    """Rows with start <= time < end and equal dimensions; pushed to the files if both bounds
    are plain values or scalar subqueries (compute an interval inside the subquery)."""
    rows = df.where((F.col(time) >= start) & (F.col(time) < end))
    for name, value in (dimensions or {}).items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows
