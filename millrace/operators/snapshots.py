"""Tables that change at once, and a latest view that is kept up to date by buckets.

A published table is a folder with data and a manifest. Rows are first written to a staged folder of their own;
then one small file with the next number is added to the manifest, and readers use the highest number there is. Until that file is there they read
the version before, whole. Nothing that a version names is ever changed or overwritten. One job publishes a
table at a time.

The latest view holds one row a key in hash buckets of the key. A batch of new rows rewrites only the buckets that
its keys fall into; the new version names the new folders of these buckets and the old ones of all others. A lookup
reads only the buckets of its keys, and within them only row groups whose Bloom filters and statistics let the keys through.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.relational import latest_by

_MANIFEST = "bucket int, folder string, note string"
# Values up to which a lookup passes its keys to the scan as a filter.
FILTERED_KEYS = 1000


def _newest(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The highest version that is there, and its manifest file; the others are listed, not read."""
    try:
        files = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").inputFiles()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        files = []
    return max(((int(f.rsplit("/version=", 1)[1].split("/")[0]), f) for f in files), default=(0, None))


def current(spark: SparkSession, path: str) -> tuple[int, dict[int, str], str | None]:
    """Number, folder of each bucket (one entry a bucket) and note of the version that readers see; (0, {}, None) before the first."""
    version, file = _newest(spark, path)
    if file is None:
        return 0, {}, None
    rows = spark.read.schema(_MANIFEST).parquet(file).collect()
    return version, {r.bucket: r.folder for r in rows if r.bucket is not None}, rows[0].note


def _switch(spark: SparkSession, path: str, version: int, folders: dict[int, str], note: str | None) -> None:
    """Readers see the new version from here on: its manifest is one file, which is moved into place whole."""
    rows = [(b, f, note) for b, f in sorted(folders.items())] or [(None, None, note)]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("error").parquet(f"{path}/manifest/version={version}")


def publish(df: DataFrame, path: str, job: str | None = None) -> int:
    """Make the rows of `df` the table at `path`; returns the version. A job that runs again under its name replaces what it has
    published, like any other: readers see its rows once."""
    spark = df.sparkSession
    version = current(spark, path)[0] + 1
    folder = f"data/{version}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{path}/{folder}")
    _switch(spark, path, version, {0: folder}, job)
    return version


def published(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The table as last published."""
    version, folders, _ = current(spark, path)
    if not version:
        raise ValueError(f"nothing has been published at {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*[f"{path}/{f}" for f in folders.values()])


# ---------------------------------------------------------------- latest view


@dataclass
class LatestView:
    """The newest row of every key, by `order` (largest wins), in hash buckets below `path`."""

    spark: SparkSession
    path: str
    schema: object
    keys: Sequence[str]
    order: Sequence[str]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        """The whole view."""
        return self._rows(list(current(self.spark, self.path)[1].values()))

    def note(self) -> str | None:
        """What the last merge has been called."""
        return current(self.spark, self.path)[2]

    def merge(self, delta: DataFrame, note: str | None = None) -> int:
        """Take in new rows, older and newer ones in any order; returns the version. The delta is read twice: pass a stored table."""
        version, folders, _ = current(self.spark, self.path)
        rows = delta.select(*self.schema.names)
        touched = sorted(r.b for r in rows.select(self.bucket().alias("b")).distinct().collect())  # at most `buckets` numbers
        old = self._rows([folders[b] for b in touched if b in folders])
        merged = latest_by(old.unionByName(rows), list(self.keys), list(self.order)).withColumn("_bucket", self.bucket())
        folder = f"data/{version + 1}-{uuid.uuid4().hex[:12]}"
        if touched:
            writer = merged.repartition(len(touched), "_bucket").sortWithinPartitions("_bucket", *self.keys).write
            for k in self.keys:
                writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
            writer.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        _switch(self.spark, self.path, version + 1, folders | {b: f"{folder}/_bucket={b}" for b in touched}, note)
        return version + 1

    def lookup(self, ids: DataFrame) -> DataFrame:
        """The newest rows of the given keys (columns `keys`); unknown ones are left out. Only the buckets of the keys are read."""
        wanted = ids.select(*[F.col(k).cast(self.schema[k].dataType).alias(k) for k in self.keys]).distinct()
        touched = {r.b for r in wanted.select(self.bucket().alias("b")).distinct().collect()}  # at most `buckets` numbers
        folders = current(self.spark, self.path)[1]
        rows = self._rows([f for b, f in sorted(folders.items()) if b in touched])
        if len(self.keys) == 1:
            few = wanted.limit(FILTERED_KEYS + 1).collect()
            if len(few) <= FILTERED_KEYS:
                return rows.where(F.col(self.keys[0]).isin([r[0] for r in few if r[0] is not None]))
        return rows.join(wanted, list(self.keys), "left_semi")
