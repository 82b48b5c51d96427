"""Job-log and model-registry analytics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.time import seconds_between
from millrace.operators import relational
from millrace.operators.ordered import GROUP_ROWS, previous_row

PENDING, APPROVED = "PendingManualApproval", "Approved"


def step_durations(df: DataFrame, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Adds `duration_s`, NULL while a step has not ended."""
    return df.withColumn("duration_s", seconds_between(F.col(start), F.col(end)))


def step_summary(df: DataFrame, by: Sequence[str], duration: str = "duration_s") -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("steps"),
        F.avg(duration).alias("avg_duration_s"),
        F.max(duration).alias("max_duration_s"),
    )


def status_changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], status: str,
                   limit: int = GROUP_ROWS) -> DataFrame:
    """Rows whose status differs from the one before; the first row counts."""
    stepped = previous_row(df, keys, order, [status], limit=limit)
    return stepped.where(~F.col(status).eqNullSafe(F.col(f"prev_{status}")))


def pending(registry: DataFrame, status: str = "status") -> DataFrame:
    return registry.where(F.col(status) == PENDING)


def latest_pending(registry: DataFrame, created: str, model_id: str, by: Sequence[str] = (), status: str = "status") -> DataFrame:
    """Newest pending model (per group)."""
    return relational.latest_by(pending(registry, status), list(by), [created, model_id])


def approve(registry: DataFrame, chosen: DataFrame, model_id: str, at: Column, status: str = "status",
            version: str = "status_time") -> DataFrame:
    """Status history with an `Approved` version appended for the chosen models;
    nothing is updated in place."""
    decided = chosen.select(model_id).join(registry, model_id).withColumn(status, F.lit(APPROVED)).withColumn(version, at)
    return registry.unionByName(decided.select(*registry.columns).distinct())


def current_status(registry: DataFrame, model_id: str, version: str = "status_time", tie: Sequence[str] = ()) -> DataFrame:
    return relational.latest_by(registry, [model_id], [version, *tie])


def registration_rows(jobs: DataFrame, metrics: DataFrame, key: str) -> DataFrame:
    """Registry rows of completed jobs whose metrics passed the gate."""
    passed = metrics.where(F.col("passed"))
    return jobs.where(F.col("job_status") == "Completed").join(passed, key).withColumn("status", F.lit(PENDING))


def deletion_plan(listing: DataFrame, prefixes: Sequence[str], path: str = "path") -> DataFrame:
    """Objects per listed prefix. Only counts; deletes nothing."""
    # A path may lie under several prefixes; the list is a parameter.
    hits = F.filter(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.startswith(F.col(path), p))
    return listing.select(F.explode(hits).alias("prefix")).groupBy("prefix").agg(F.count(F.lit(1)).alias("objects"))


def cost(df: DataFrame, by: Sequence[str], hours: Column, rate: Column, quantity: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(hours * rate * quantity).alias("cost"))


def match_rules(events: DataFrame, rules: Sequence[Mapping[str, object]]) -> DataFrame:
    """One row per (event, matching rule). A rule names its `rule`, optional
    `source` and `detail_type`, and `detail`: field -> allowed values, or
    {"prefix": p}. The rules are a parameter, so the match is an expression and
    works on batches and streams alike."""

    def condition(rule: Mapping[str, object]) -> Column:
        ok = F.lit(True)
        for field in ("source", "detail_type"):
            if field in rule:
                ok = ok & (F.col(field) == F.lit(rule[field]))
        for field, wanted in rule.get("detail", {}).items():
            value = F.col(f"detail.{field}")
            ok = ok & (F.startswith(value, F.lit(wanted["prefix"])) if isinstance(wanted, Mapping) else value.isin(list(wanted)))
        return F.coalesce(ok, F.lit(False))

    hits = F.array_compact(F.array(*[F.when(condition(r), F.lit(r["rule"])) for r in rules]))
    return events.withColumn("rule", F.explode(hits))
