"""How much each feature matters to a fitted model, window by window.

The model is scored again with one feature taken from another row (permutation importance). The other row is
the next one of the same window in the order of a hash, the last one being followed by the first; large
windows are dealt into buckets by the hash, so that no task orders a whole window. One shuffle serves all features.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_ROWS = 10_000
LEAST_P = 1e-15


def exchanged(df: DataFrame, key: str, carried: str, by: Sequence[str] = (), seed: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds `partner`, the `carried` column of another row of the same window: within each bucket a cycle, so that every
    row is partner once. A row alone in its window is its own partner. `key` tells rows apart."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    own = [f"_by{i}" for i in range(len(by))]
    sizes = df.groupBy(*[F.col(c).alias(o) for c, o in zip(by, own, strict=True)]).agg(F.ceil(F.count(F.lit(1)) / bucket_rows).alias("_buckets"))
    same = [F.col(c).eqNullSafe(F.col(o)) for c, o in zip(by, own, strict=True)]
    joined = df.join(sizes, same).drop(*own) if by else df.crossJoin(F.broadcast(sizes))  # one row
    dealt = joined.withColumn("_order", digest).withColumn("_bucket", F.conv(F.substring("_order", 1, 15), 16, 10).cast("bigint") % F.col("_buckets"))
    group = W.partitionBy(*by, "_bucket")
    ordered = group.orderBy("_order", key)
    first = F.first(F.struct(carried)).over(ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    following = F.lead(F.struct(carried)).over(ordered)
    return dealt.withColumn("partner", F.coalesce(following, first)[carried]).drop("_buckets", "_order", "_bucket")


def log_loss(p: Column, label: Column) -> Column:
    """Of the probability of class 1, or of the list of all classes' probabilities."""
    return -F.ln(F.greatest(F.when(label == 1, p).otherwise(1 - p), F.lit(LEAST_P)))


def multiclass_log_loss(p: Column, label: Column) -> Column:
    return -F.ln(F.greatest(F.get(p, label.cast("int")), F.lit(LEAST_P)))


def permutation_importance(df: DataFrame, score: Callable[[DataFrame], DataFrame], features: Sequence[str], key: str, by: Sequence[str] = (),
                           vector: str = "features", label: str = "label", loss: Callable[[Column, Column], Column] = log_loss,
                           seed: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(by..., feature, n, loss, importance): mean loss of the model as it is and its rise when the feature is exchanged.

    `score` adds `p` to rows with the feature vector; it is applied once, to every row as it is and once more for
    each feature. `vector` is an array; features without effect have importance 0."""
    rows = exchanged(df.select(*by, key, vector, F.col(label).alias("_label")), key, vector, by, seed, bucket_rows)
    variants = rows.withColumn("_feature", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))))
    swapped = F.transform(vector, lambda v, i: F.when(i == F.col("_feature"), F.get("partner", i)).otherwise(v))
    told = score(variants.withColumn(vector, swapped).drop("partner"))
    means = told.groupBy(*by, "_feature").agg(F.count(F.lit(1)).alias("n"), F.avg(loss(F.col("p"), F.col("_label"))).alias("_loss"))
    names = F.array(*[F.lit(f) for f in features])
    # As many rows as windows and features.
    base = F.max(F.when(F.col("_feature") == -1, F.col("_loss"))).over(W.partitionBy(*by) if by else W.partitionBy(F.lit(0)))
    out = means.withColumn("loss", base).where("_feature >= 0")
    return out.select(*by, F.get(names, F.col("_feature")).alias("feature"), "n", "loss", (F.col("_loss") - F.col("loss")).alias("importance"))
