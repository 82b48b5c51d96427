"""Imputation, feature encoding and repeatable splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.numeric import hash_bucket, map_encode
from millrace.functions.text import title_of
from millrace.operators.ordered import row_index
from millrace.operators.stats import medians, modes


def nan_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One notion of missing: NaN becomes NULL."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols})


def _fill(df: DataFrame, fitted: DataFrame, cols: Sequence[str], column: str) -> DataFrame:
    # The fitted rows folded into one struct: a single scalar subquery, planned
    # once for all columns, and no join touches `df`.
    kinds = {c: "double" if column == "median" else df.schema[c].dataType for c in cols}
    one = fitted.agg(F.struct(*[F.max(F.when(F.col("feature") == c, F.col(column))).cast(kinds[c]).alias(c) for c in cols]).alias("_v"))
    value = one.scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast(kinds[c]), value[c]) for c in cols})


def impute_median(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """NULL to the exact median, fitted on `fit_on` (say, the training part).
    All medians come from one aggregation; the result is double."""
    return _fill(df, medians(fit_on or df, cols), cols, "median")


def impute_mode(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """NULL to the most frequent value, the smallest one on a tie."""
    return _fill(df, modes(fit_on or df, cols), cols, "mode")


def impute_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """NULL to a constant. The constant's type wins, so 28.7 stays 28.7 in a
    column of whole numbers."""
    filled = {}
    for c, v in values.items():
        col = F.col(c).cast("double") if isinstance(v, float) else F.col(c)
        filled[c] = F.coalesce(col, F.lit(v))
    return df.withColumns(filled)


def title_code(name: Column, codes: Mapping[str, int], synonyms: Mapping[str, str], rare: Sequence[str],
               rare_name: str = "Rare", missing: int = 0, find=title_of) -> Column:
    """Title of a name: rare ones grouped, synonyms collapsed, then coded; no or
    an unknown title gives `missing`."""
    title = find(name)
    grouped = F.coalesce(map_encode(title, {**{r: rare_name for r in rare}, **synonyms}), title)
    return map_encode(grouped, codes, default=missing)


def assign_split(df: DataFrame, key: str, train_pct: int = 80, seed: int = 42, name: str = "split",
                 labels: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Train/test label from a hash of the key: the two sides are disjoint and
    complete, and the answer does not depend on partitioning or run."""
    in_train = hash_bucket(F.col(key), 100, seed) < train_pct
    return df.withColumn(name, F.when(in_train, labels[0]).otherwise(labels[1]))


def assign_exact_split(df: DataFrame, key: str, train_pct: int = 80, seed: int = 42, name: str = "split",
                       labels: tuple[str, str] = ("train", "test")) -> DataFrame:
    """As above with an exact train size of floor(n * pct / 100)."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    ranked = row_index(df.withColumn("_h", order), [], ["_h", key], "_rn")
    size = F.floor(df.agg(F.count(F.lit(1))).scalar() * train_pct / 100)
    return ranked.withColumn(name, F.when(F.col("_rn") <= size, labels[0]).otherwise(labels[1])).drop("_h", "_rn")


def flip_labels(df: DataFrame, label: str, key: str, pct: int, seed: int = 42) -> DataFrame:
    """Label noise: 1 - y on a hash-chosen percentage of the rows."""
    chosen = hash_bucket(F.col(key), 100, f"flip{seed}") < pct
    return df.withColumn(label, F.when(chosen, 1 - F.col(label)).otherwise(F.col(label)))


def split_overlap(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Number of test keys that also occur in training (0 = no leakage)."""
    return test.select(key).join(train.select(key), key, "left_semi").agg(
        F.count(F.lit(1)).alias("overlap")
    )
