"""Feature groups: typed append-only history, latest view, training sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.text import records_to_map
from millrace.functions.time import micros
from millrace.operators import relational
from millrace.operators.ordered import GROUP_ROWS, asof_join, previous_row

# The three feature types a group may declare.
TYPES = {"String": T.StringType(), "Integral": T.LongType(), "Fractional": T.DoubleType()}


@dataclass(frozen=True)
class FeatureGroup:
    """Name, record id, event time and declared features of a group.

    `event_time` holds fractional epoch seconds, or a timestamp when declared so.
    """

    name: str
    record_id: str
    event_time: str
    features: Mapping[str, str]

    def __post_init__(self):
        unknown = {t for t in self.features.values() if t not in TYPES}
        if unknown:
            raise ValueError(f"feature types must be among {sorted(TYPES)}: {sorted(unknown)}")
        for role in (self.record_id, self.event_time):
            if role not in self.features:
                raise ValueError(f"{role} is not a declared feature of {self.name}")
        if self.features[self.event_time] != "Fractional":
            raise ValueError("event time must be Fractional epoch seconds")

    @property
    def schema(self) -> T.StructType:
        required = {self.record_id, self.event_time}
        return T.StructType([T.StructField(n, TYPES[t], n not in required) for n, t in self.features.items()])

    @property
    def table(self) -> str:
        return self.name.replace("-", "_")

    @property
    def values(self) -> list[str]:
        return [c for c in self.features if c not in (self.record_id, self.event_time)]


def conform(df: DataFrame, group: FeatureGroup) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rows cast to the declared types, and the raw rows
    whose id or event time is missing or with a value that does not convert."""
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in group.schema}
    bad = typed[group.record_id].isNull() | typed[group.event_time].isNull()
    for name, value in typed.items():
        bad = bad | (F.col(name).isNotNull() & value.isNull())
    accepted = df.where(~bad).select(*[v.alias(n) for n, v in typed.items()])
    return accepted, df.where(bad)


def ingest_counts(df: DataFrame, group: FeatureGroup) -> DataFrame:
    """Accepted and rejected row numbers of a batch, in one pass."""
    accepted, rejected = conform(df, group)
    tagged = relational.tagged_union(
        "status", {"accepted": accepted.select(group.record_id), "rejected": rejected.select(group.record_id)}
    )
    return tagged.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def ingest(df: DataFrame, group: FeatureGroup, path: str) -> DataFrame:
    """Append the accepted rows to the group's history; returns the rejected ones."""
    accepted, rejected = conform(df, group)
    accepted.write.mode("append").parquet(path)
    return rejected


def decode_records(df: DataFrame, records: str, group: FeatureGroup) -> DataFrame:
    """(FeatureName, ValueAsString) lists to typed columns; absent features are NULL."""
    fields = records_to_map(F.col(records))
    return df.select(
        *[F.try_element_at(fields, F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in group.schema]
    )


def history(spark, group: FeatureGroup) -> DataFrame:
    """The group's table or view by its catalogue name."""
    return spark.table(group.table)


def latest(df: DataFrame, group: FeatureGroup, tie: Sequence[str] = ()) -> DataFrame:
    """Newest version of every record."""
    return relational.latest_by(df, [group.record_id], [group.event_time, *tie])


def get_records(df: DataFrame, group: FeatureGroup, ids: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Newest version of the requested ids. The ids filter the history before it
    is aggregated."""
    return latest(relational.lookup(df, ids, group.record_id), group, tie)


def version_changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                    limit: int = GROUP_ROWS) -> DataFrame:
    """Every version beside the value of the version before and the change."""
    stepped = previous_row(df, keys, order, [value], limit=limit)
    return stepped.withColumn("change", F.col(value) - F.col(f"prev_{value}"))


def training_query(df: DataFrame, group: FeatureGroup, cols: Sequence[str], where: Column | None = None,
                   latest_only: bool = False, tie: Sequence[str] = ()) -> DataFrame:
    """Projection and filter over the history, or over the newest versions only."""
    source = latest(df, group, tie) if latest_only else df
    return (source if where is None else source.where(where)).select(*cols)


def point_in_time(events: DataFrame, df: DataFrame, keys: Sequence[str], event_time: str, feature_time: str,
                  features: Sequence[str], tie: Sequence[str] = (), how: str = "left",
                  limit: int = GROUP_ROWS) -> DataFrame:
    """Training rows with the features as known at their event time."""
    return asof_join(events, df, keys, event_time, feature_time, features, tie, how, limit)


def leakage_audit(events: DataFrame, df: DataFrame, keys: Sequence[str], event_time: str, feature_time: str,
                  feature: str, tie: Sequence[str] = (), limit: int = GROUP_ROWS) -> DataFrame:
    """Rows whose feature is younger than the event: after joining the newest
    version (naive) and after the point-in-time join (must be 0)."""
    newest = df.groupBy(*keys).agg(F.max(feature_time).alias("feature_time"))
    # One row per key and event time carries the count: a hot key stays small.
    counted = events.groupBy(*keys, event_time).agg(F.count(F.lit(1)).alias("_n"))
    late = F.when(F.col("feature_time") > F.col(event_time), F.col("_n")).otherwise(0)
    naive = relational.lookup_join_by(counted, newest, keys).agg(
        F.sum(late).alias("leaking"), F.sum("_n").alias("n_rows")
    )
    exact = point_in_time(events, df, keys, event_time, feature_time, [feature], tie, limit=limit).agg(
        F.count_if(F.col("feature_time") > F.col(event_time)).alias("leaking"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return relational.tagged_union("method", {"newest": naive, "point_in_time": exact})


def assemble_vectors(requests: DataFrame, sides: Sequence[tuple[DataFrame, str, str, Mapping[str, object]]]) -> DataFrame:
    """One feature vector per request row. Each side is (latest view, key, prefix,
    defaults by prefixed name)."""
    for side, key, prefix, defaults in sides:
        requests = relational.left_with_defaults(requests, relational.prefixed(side, key, prefix), key, defaults)
    return requests


def freshness(df: DataFrame, by: Sequence[str], time: str, as_of: Column) -> DataFrame:
    """Seconds between the newest event of each group and `as_of`."""
    newest = df.groupBy(*by).agg(F.max(time).alias("_newest"))
    return newest.select(*by, ((micros(as_of) - micros(F.col("_newest"))) / F.lit(1000000.0)).alias("lag_seconds"))
