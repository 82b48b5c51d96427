"""Data-quality checks. All return rows; none reads the table once per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _unpivoted(one_row: DataFrame, cols: Sequence[str], names: Sequence[str]) -> DataFrame:
    """A one-row aggregate with `<col>__<name>` columns as one row per col."""
    entries = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{n}").alias(n) for n in names]) for c in cols
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("_r")).select("_r.*")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, nulls, n_rows) from one aggregate over the table."""
    cols = list(cols or df.columns)
    counted = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in cols],
        *[F.count(F.lit(1)).alias(f"{c}__n_rows") for c in cols],
    )
    return _unpivoted(counted, cols, ["nulls", "n_rows"])


def conformance(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Completeness and type conformance per column: the share of non-NULL values
    and, of those, the share that converts to the declared type."""
    cols = list(kinds)
    counted = df.agg(
        *[F.avg(F.col(c).isNotNull().cast("double")).alias(f"{c}__completeness") for c in cols],
        *[
            F.try_divide(
                F.count(F.col(c).try_cast(kind)).cast("double"), F.count(F.col(c))
            ).alias(f"{c}__type_conformance")
            for c, kind in kinds.items()
        ],
    )
    return _unpivoted(counted, cols, ["completeness", "type_conformance"])


def violations(df: DataFrame, not_null: Sequence[str] = (), domains: Mapping[str, Sequence] | None = None,
               rules: Mapping[str, Column] | None = None) -> DataFrame:
    """(check_name, failures) for: table not empty, columns not NULL, values in
    their domain (NULL is outside it), and free rules that must hold."""
    checks = {"not_empty": F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint")}
    for c in not_null:
        checks[f"not_null:{c}"] = F.count_if(F.col(c).isNull())
    for c, allowed in (domains or {}).items():
        checks[f"domain:{c}"] = F.count_if(F.coalesce(~F.col(c).isin(list(allowed)), F.lit(True)))
    for name, rule in (rules or {}).items():
        checks[name] = F.count_if(~F.coalesce(rule, F.lit(False)))
    one_row = df.agg(*[expr.alias(f"_{i}") for i, expr in enumerate(checks.values())])
    rows = [F.struct(F.lit(n).alias("check_name"), F.col(f"_{i}").alias("failures")) for i, n in enumerate(checks)]
    return one_row.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def require(df: DataFrame, **checks) -> DataFrame:
    """`df` itself when every check passes, else an error naming the failures.
    One aggregate job, run before a write."""
    failed = violations(df, **checks).where("failures > 0").collect()
    if failed:
        raise ValueError("; ".join(f"{r.check_name}: {r.failures}" for r in failed))
    return df
