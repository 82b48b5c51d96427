"""Operators that need an order: as-of joins, version changes, running totals,
exact quantiles, KS distance, AUC.

A window sorts one group in one task. That is the cheapest plan while groups are
small, and a stall once one key holds a third of the table. Every operator here
therefore checks the size of its largest group first and has two plans:

* groups fit: one window over the keys, one shuffle;
* a group is too large: rows are range-partitioned by (keys, order), so that a
  hot key spans many partitions; the partition number is written with the rows
  (a stable chunk id, and a lineage cut); windows then run per (keys, chunk) and
  a small per-chunk summary, at most one row per key and chunk, carries state
  from one chunk to the next.

Both give the same rows; the limit only decides the plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.operators.relational import lookup_join, lookup_join_by
from millrace.session import written

# Rows one task may sort for a single group.
GROUP_ROWS = 1_000_000

# Ranges a shuffle is cut into at most; beyond, chunks grow with the table.
MAX_CHUNKS = 100_000

# Rows a chunk may always have, however low the limit: a range costs a task and a file.
CHUNK_ROWS = 50_000

# Value buckets per round of a quantile selection.
BUCKETS = 1_000

_CHUNK = "_chunk"
_TIE = "_tie"


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest key group (one row reaches the driver)."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def chunks_needed(df: DataFrame, keys: Sequence[str], limit: int) -> int:
    """0 when every key group has at most `limit` rows, else the number of chunks
    that brings a chunk down to that or to CHUNK_ROWS (MAX_CHUNKS at most). The row count, which Parquet answers from
    its footers, settles small tables without a look at the keys."""
    rows = df.count()
    if rows <= limit or (keys and largest_group(df, keys) <= limit):
        return 0
    return min(-(-rows // max(limit, CHUNK_ROWS)), MAX_CHUNKS)


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: int) -> DataFrame:
    """`df` written with a chunk id: chunks follow the (keys, order) order and are
    of about equal size, whatever the key sizes. `_tie` spreads rows equal in all
    order columns."""
    parts = max(chunks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys, *order, _TIE)
        .withColumn(_CHUNK, F.spark_partition_id())
    )
    return written(ranged, "chunks")


def _by(keys: Sequence[str]):
    return W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))


# --------------------------------------------------------------------- as-of


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    features: Sequence[str],
    tie: Sequence[str] = (),
    how: str = "left",
    limit: int = GROUP_ROWS,
) -> DataFrame:
    """Each left row with the newest right version at or before its time.

    Both sides are stacked and the last version seen is carried forward: no
    row blow-up. Of versions with equal key and time the one with the greatest
    `tie` columns counts. `how="inner"` drops rows that precede every version.
    Adds the feature columns and `<right_time>` as `feature_time`.
    """
    payload = F.struct(F.col(right_time).alias("feature_time"), *features)
    ties = {"_tie_by": F.struct(*tie)} if tie else {}
    versions = right.dropna(subset=[*keys, right_time]).select(
        *keys, F.col(right_time).alias("_t"), payload.alias("_v"), F.lit(0).alias("_side"), *[c.alias(n) for n, c in ties.items()]
    )
    # Columns both sides share travel once, outside the row.
    shared = {k: k for k in keys if left.schema[k].dataType == right.schema[k].dataType}
    if left.schema[left_time].dataType == right.schema[right_time].dataType:
        shared[left_time] = "_t"
    rest = [c for c in left.columns if c not in shared]
    probe = left.select(
        *keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), *([F.struct(*rest).alias("_row")] if rest else [])
    )
    chunks = max(chunks_needed(left, keys, limit), chunks_needed(right, keys, limit))
    if not chunks:
        upto = _by(keys).orderBy("_t", "_side", *ties, "_v").rowsBetween(W.unboundedPreceding, W.currentRow)
        points = versions.unionByName(probe, allowMissingColumns=True)
        filled = points.withColumn("_v", F.last("_v", ignorenulls=True).over(upto))
    else:
        # Copies of a version fold before whole rows are shuffled.
        single = versions.groupBy(*keys, "_t", "_side").agg(F.max_by("_v", F.struct(*ties, "_v")).alias("_v"))
        filled = _carry_forward(single.unionByName(probe, allowMissingColumns=True), keys, chunks)
    result = filled.where("_side = 1")
    if how == "inner":
        result = result.where("_v IS NOT NULL")
    return result.select(
        *[F.col(shared[c]).alias(c) if c in shared else F.col(f"_row.{c}").alias(c) for c in left.columns],
        F.col("_v.feature_time").alias("feature_time"),
        *[F.col(f"_v.{c}").alias(c) for c in features],
    )


def history_totals(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    sums: Mapping[str, Column],
    left_id: str,
    limit: int = GROUP_ROWS,
) -> DataFrame:
    """Each left row with totals over ALL right versions at or before its time.

    What a range join (key equal, version time <= row time) followed by a group-by
    gives, without ever forming the (row, version) pairs: one running total.
    """
    points = (
        right.select(*keys, F.col(right_time).alias("_t"), *[c.alias(f"_v_{n}") for n, c in sums.items()])
        .withColumn("_side", F.lit(0))
        .unionByName(
            left.select(
                *keys, F.col(left_time).alias("_t"), F.struct(*left.columns).alias("_row"), F.lit(1).alias("_side")
            ),
            allowMissingColumns=True,
        )
    )
    parts = {n: F.coalesce(F.col(f"_v_{n}"), F.lit(0)) for n in sums}
    points = points.withColumn("_id", F.col(f"_row.{left_id}"))
    totals = running_totals(points, keys, ["_t", "_side", "_id"], parts, limit=limit)
    return totals.where("_side = 1").select("_row.*", *[F.col(f"{n}_upto").alias(n) for n in sums])


def _carry_forward(points: DataFrame, keys: Sequence[str], chunks: int) -> DataFrame:
    """Last non-NULL `_v` up to each row, over chunks of (keys, _t, _side)."""
    rows = chunked(points, keys, ["_t", "_side"], chunks)
    newest = rows.groupBy(*keys, _CHUNK).agg(
        F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_t"))).alias("_v")
    )
    before = _by(keys).orderBy(_CHUNK).rowsBetween(W.unboundedPreceding, -1)
    carry = newest.select(
        *keys, _CHUNK, F.last("_v", ignorenulls=True).over(before).alias("_v"), F.lit(-1).alias("_side")
    ).where("_v IS NOT NULL")
    # A carried version opens its chunk: NULL `_t` sorts first.
    opened = rows.unionByName(carry, allowMissingColumns=True)
    order = _by([*keys, _CHUNK]).orderBy(F.col("_t").asc_nulls_first(), "_side", _TIE).rowsBetween(W.unboundedPreceding, W.currentRow)
    return opened.withColumn("_v", F.last("_v", ignorenulls=True).over(order)).where("_side >= 0")


# ------------------------------------------------------------- previous row


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    prefix: str = "prev_",
    limit: int = GROUP_ROWS,
) -> DataFrame:
    """Adds `prev_<col>`: the value in the row before, per key. `order` must be
    total within a key for a repeatable answer."""
    chunks = chunks_needed(df, keys, limit)
    if not chunks:
        window = _by(keys).orderBy(*order)
        return df.withColumns({prefix + c: F.lag(c).over(window) for c in cols})
    rows = chunked(df, keys, order, chunks)
    position = F.struct(*order, _TIE)
    last = rows.groupBy(*keys, _CHUNK).agg(F.max_by(F.struct(*cols), position).alias("_last"))
    carry = last.withColumn("_last", F.lag("_last").over(_by(keys).orderBy(_CHUNK))).where("_last IS NOT NULL")
    opener = carry.select(
        *keys, _CHUNK, F.lit(True).alias("_open"), *[F.col(f"_last.{c}").alias(c) for c in cols if c not in keys]
    )
    opened = rows.withColumn("_open", F.lit(False)).unionByName(opener, allowMissingColumns=True)
    window = _by([*keys, _CHUNK]).orderBy(F.col("_open").desc(), *order, _TIE)
    return (
        opened.withColumns({prefix + c: F.lag(c).over(window) for c in cols})
        .where(~F.col("_open"))
        .drop("_open", _CHUNK, _TIE)
    )


# ------------------------------------------------------------ running totals


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    limit: int = GROUP_ROWS,
    chunks: int | None = None,
) -> DataFrame:
    """Adds, for each name in `sums`, `<name>_upto` (running total including the
    row) and `<name>_total` (total of the key group). `order` must be total.
    `chunks` is passed by callers that have measured the groups already."""
    inputs = {f"_in_{n}": c for n, c in sums.items()}
    df = df.withColumns(inputs)
    if chunks is None:
        chunks = chunks_needed(df, keys, limit)
    if not chunks:
        # Both frames share one order, hence one sort and one window operator.
        upto = _by(keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
        whole = _by(keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        added = {f"{n}_upto": F.sum(f"_in_{n}").over(upto) for n in sums}
        added |= {f"{n}_total": F.sum(f"_in_{n}").over(whole) for n in sums}
        return df.withColumns(added).drop(*inputs)
    rows = chunked(df, keys, order, chunks)
    totals = rows.groupBy(*keys, _CHUNK).agg(*[F.sum(f"_in_{n}").alias(f"_s_{n}") for n in sums])
    before = _by(keys).orderBy(_CHUNK).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        _CHUNK,
        *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums],
        *[F.sum(f"_s_{n}").over(_by(keys)).alias(f"{n}_total") for n in sums],
    )
    upto = _by([*keys, _CHUNK]).orderBy(*order, _TIE).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = rows.withColumns({f"_local_{n}": F.sum(f"_in_{n}").over(upto) for n in sums})
    on = F.lit(True)
    left, right = local.alias("l"), offsets.alias("o")
    for k in [*keys, _CHUNK]:
        on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"o.{k}"))
    return left.join(right, on).select(
        *[F.col(f"l.{c}").alias(c) for c in df.columns if c not in inputs],
        *[(F.col(f"l._local_{n}") + F.col(f"o._before_{n}")).alias(f"{n}_upto") for n in sums],
        *[F.col(f"o.{n}_total").alias(f"{n}_total") for n in sums],
    )


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn", limit: int = GROUP_ROWS) -> DataFrame:
    """1-based position per key (whole table without keys)."""
    chunks = chunks_needed(df, keys, limit)
    if not chunks:
        return df.withColumn(name, F.row_number().over(_by(keys).orderBy(*order)).cast("bigint"))
    counted = running_totals(df, keys, order, {name: F.lit(1)}, chunks=chunks)
    return counted.withColumnRenamed(f"{name}_upto", name).drop(f"{name}_total")


def after_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """Rows past the first `k` per key (warm-up exclusion). Only the k smallest
    positions per key are ranked, and each map task keeps just k of them."""
    position = F.struct(*order)
    ranked = df.select(*keys, position.alias("_pos")).withColumn(
        "_rn", F.row_number().over(_by(keys).orderBy("_pos"))
    )
    edge = ranked.where(F.col("_rn") <= k).groupBy(*keys).agg(F.max("_pos").alias("_edge"))
    warm = lookup_join_by(df, edge, keys, "inner")
    return warm.where(position > F.col("_edge")).drop("_edge")


# ----------------------------------------------------------------- quantiles


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    kind: str = "interpolated",
    limit: int = GROUP_ROWS,
) -> DataFrame:
    """Exact quantiles per key as one column each; NULL values are skipped.

    Values are counted first (map-side), so copies cost nothing, and the counts
    are ranked. For groups over the limit only the value ranges that hold a wanted
    position are ranked at all.
    """
    known = df.where(F.col(value).isNotNull()).select(*keys, value)
    chunks = chunks_needed(known, keys, limit)
    if chunks:
        return _selected_quantiles(known, keys, value, probs, kind, limit)
    counts = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(counts, keys, [value], {"c": F.col("_n")}, chunks=0)
    return _picked(ranked.withColumn("_total", F.col("c_total")), keys, value, probs, kind)


def _positions(total: Column, p: float, kind: str) -> tuple[Column, Column]:
    """0-based positions of the one or two elements a quantile is made of."""
    if kind == "positional":
        at = F.least(F.floor(total * F.lit(p)), total - 1)
        return at, at
    exact = (total - 1) * F.lit(float(p))
    return F.floor(exact), F.ceil(exact)


def _picked(ranked: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], kind: str) -> DataFrame:
    """Quantile columns from counted values with their running total `c_upto`
    (within the group) and the group's `_total`."""
    upto, first = F.col("c_upto"), F.col("c_upto") - F.col("_n")

    def element(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position < upto), F.col(value).cast("double")))

    out = []
    for name, p in probs.items():
        low, high = _positions(F.col("_total"), p, kind)
        if kind == "positional":
            out.append(element(low).alias(name))
            continue
        share = F.max((F.col("_total") - 1) * F.lit(float(p)) - low)
        out.append((element(low) + (element(high) - element(low)) * share).alias(name))
    return ranked.groupBy(*keys).agg(*out)


def _bucketed(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the number of an about equally full value range."""
    numeric = rows.withColumn("_x", F.col(value).cast("double"))
    marks = [i / BUCKETS for i in range(1, BUCKETS)]
    cuts = sorted(set(numeric.approxQuantile("_x", marks, 0.25 / BUCKETS)))
    if not cuts:
        return rows.withColumn(name, F.lit(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    return Bucketizer(splits=splits, inputCol="_x", outputCol=name, handleInvalid="keep").transform(numeric).drop("_x")


def _selected_quantiles(known: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], kind: str,
                        limit: int) -> DataFrame:
    """Exact quantiles without sorting everything. Each round cuts the value range
    of the remaining rows into buckets, counts them per cell (key and buckets so
    far) and keeps the rows of cells that hold a wanted position, until a cell
    has at most `limit` rows; those are ranked. Three rounds narrow a cell a
    billionfold; more are of no use, what is left then are copies, which count
    as one."""
    rows = known.withColumns({"_base": F.lit(0).cast("bigint"), "_total": F.lit(None).cast("bigint")})
    path = list(keys)
    for round_ in range(3):
        bucket = f"_b{round_}"
        placed = _bucketed(rows, value, bucket)
        sizes = placed.groupBy(*path, bucket).agg(
            F.count(F.lit(1)).alias("_m"), F.min("_base").alias("_base"), F.min("_total").alias("_total")
        )
        # At most BUCKETS + 1 rows per cell of the round before.
        through = _by(path).orderBy(bucket).rowsBetween(W.unboundedPreceding, W.currentRow)
        end = F.col("_base") + F.sum("_m").over(through)
        cells = sizes.select(
            *path, bucket, "_m", (end - F.col("_m")).alias("_start"), end.alias("_end"),
            F.coalesce(F.col("_total"), F.sum("_m").over(_by(path))).alias("_all"),
        )
        hit = F.lit(False)
        for p in probs.values():
            for at in _positions(F.col("_all"), p, kind):
                hit = hit | ((F.col("_start") <= at) & (at < F.col("_end")))
        path.append(bucket)
        # A few cells per key, read three times below.
        wanted = written(cells.where(hit), "cells")
        side = wanted.select(*path, F.col("_start").alias("_base"), F.col("_all").alias("_total"))
        rows = lookup_join_by(placed.drop("_base", "_total"), side, path, "inner")
        if (wanted.agg(F.max("_m")).first()[0] or 0) <= limit:
            break
    counts = rows.groupBy(*path, value, "_base", "_total").agg(F.count(F.lit(1)).alias("_n"))
    upto = _by(path).orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = counts.withColumn("c_upto", F.sum("_n").over(upto) + F.col("_base"))
    return _picked(ranked, keys, value, probs, kind)


# ------------------------------------------------- distribution comparison


def ks_distance(
    df: DataFrame, keys: Sequence[str], value: str, is_current: Column, limit: int = GROUP_ROWS
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per key: the largest gap between
    the two empirical distribution functions, with both sample sizes."""
    known = df.where(F.col(value).isNotNull())
    counts = (
        known.withColumn("_cur", is_current.cast("bigint"))
        .groupBy(*keys, value)
        .agg(F.sum(1 - F.col("_cur")).alias("_b"), F.sum("_cur").alias("_c"))
    )
    sums = {"b": F.col("_b"), "c": F.col("_c")}
    cum = running_totals(counts, keys, [value], sums, chunks=chunks_needed(known, keys, limit))
    gap = F.abs(
        F.try_divide(F.col("b_upto"), F.col("b_total")) - F.try_divide(F.col("c_upto"), F.col("c_total"))
    )
    return cum.groupBy(*keys).agg(
        F.max(gap).alias("ks"), F.max("b_total").alias("n_baseline"), F.max("c_total").alias("n_current")
    )


def rank_auc(df: DataFrame, keys: Sequence[str], score: str, label: str, limit: int = GROUP_ROWS) -> DataFrame:
    """Area under the ROC curve in its rank form: the share of (positive,
    negative) pairs ranked right, a tie counting half. No pair is ever formed."""
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = known.groupBy(*keys, score).agg(
        F.sum(F.col(label).cast("bigint")).alias("_p"),
        F.sum(1 - F.col(label).cast("bigint")).alias("_n"),
    )
    sums = {"p": F.col("_p"), "n": F.col("_n")}
    cum = running_totals(counts, keys, [score], sums, chunks=chunks_needed(known, keys, limit))
    # Pair numbers outgrow a bigint long before a table does: count them in double.
    won = F.col("_p") * (F.col("n_upto") - F.col("_n") / 2.0)
    pairs = F.col("p_total").cast("double") * F.col("n_total")
    return cum.groupBy(*keys).agg(
        F.try_divide(F.sum(won), F.max(pairs)).alias("auc"),
        F.max("p_total").alias("positives"),
        F.max("n_total").alias("negatives"),
    )
