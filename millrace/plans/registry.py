"""Query registry and table access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.time import utc
from millrace.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, list[str]] = {}

# Columns that hold zone-less timestamps in the given tables.
_TIMES = {"events": ["ts"], "orders": ["o_orderdate"], "lineitem": ["l_shipdate"]}


class Tables:
    """The given tables below one folder: `t.events`, `t.orders`, ..."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return df.withColumns({c: utc(F.col(c)) for c in _TIMES[name]}) if name in _TIMES else df

    def spread(self, name: str, key: str) -> DataFrame:
        """A table for CPU-heavy work. A scan with fewer splits than cores (few,
        large row groups) is spread over the cores first; a large one is left alone."""
        df = getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def query(covers: str, sql: str | None = None):
    """Register a function of Tables under its own name. `covers` lists the
    inventory ids it shows; `sql` is its check."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(configure(spark), folder))

        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        COVERS[name] = covers.split()
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
