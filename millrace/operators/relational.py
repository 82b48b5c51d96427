"""Joins, top-k and set operations beyond one DataFrame call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


# Rows up to which a measured table is broadcast.
BROADCAST_ROWS = 200_000

# Bytes up to which it is broadcast, estimated by its JSON form.
BROADCAST_BYTES = 64 << 20

# A key is heavy when it holds more than 1/HEAVY_SHARE of all rows, so there are
# never more than HEAVY_SHARE heavy keys, whatever the table size.
HEAVY_SHARE = 10_000


def heavy_keys(sizes: DataFrame, n: str = "n") -> DataFrame:
    """The rows of a (key, n) table that are heavy: at most HEAVY_SHARE of them."""
    total = sizes.agg(F.sum(n)).scalar()
    return sizes.where(F.col(n) > total / HEAVY_SHARE)


def fits_broadcast(side: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a side is small enough to broadcast, in rows and in (estimated) bytes. Looks at
    no more than `limit` + 1 rows."""
    size = F.length(F.to_json(F.struct(*side.columns)))
    n, b = side.limit(limit + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= limit and b <= most_bytes


def lookup_join(fact: DataFrame, side: DataFrame, key: str, how: str = "left", spread_by: Sequence[str] = (),
                size: str | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join a fact table to a side with one row per key, safe against hot keys. The result has
    the fact's columns, then the side's others, whatever the sizes.

    A side of at most `limit` rows and BROADCAST_BYTES is broadcast. Beyond that the heavy
    keys, a bounded number, are broadcast, and only the other rows have to meet their
    side row in a shuffle; heavy rows are spread over all its tasks by a hash of
    `spread_by` (default: all columns that can be hashed). `size` names the side's column with
    the fact rows per key, if it has one; else they are counted. The side is read
    more than once: pass a stored table when it is expensive.
    """
    cols = [c for c in side.columns if c != key]
    if fits_broadcast(side, limit):
        return fact.join(F.broadcast(side), key, how).select(*fact.columns, *cols)
    row = F.struct(*cols) if cols else F.struct(F.lit(True).alias("_any"))
    if size:
        heavy = heavy_keys(side, size).select(key, row.alias("_heavy"))
    else:
        keys = heavy_keys(fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))).select(key)
        found = side.join(F.broadcast(keys), key, "left_semi").select(key, row.alias("_heavy"))
        heavy = keys.join(found, key, "left")
    known = fact.join(F.broadcast(heavy.withColumn("_hot", F.lit(True))), key, "left")
    # Rows that need no side row any more, or can have none, go anywhere.
    free = F.col("_hot").isNotNull() | F.col(key).isNull()
    hashed = spread_by or [f.name for f in fact.schema.fields if "map<" not in f.dataType.simpleString()]
    # The partition's number keeps copies of one row apart.
    slot = F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), F.lit(HEAVY_SHARE)).cast("int") + 1
    known = known.withColumn("_slot", F.when(free, slot).otherwise(0)).drop("_hot")
    others = side.select(key, row.alias("_other"), F.lit(0).alias("_slot"))
    joined = known.join(others, [key, "_slot"], "left").withColumn("_found", F.coalesce("_heavy", "_other"))
    if how == "inner":
        joined = joined.where("_found IS NOT NULL")
    return joined.select(*fact.columns, *[F.col("_found")[c].alias(c) for c in cols])


def lookup_join_by(fact: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left",
                   limit: int = BROADCAST_ROWS) -> DataFrame:
    """The same over several key columns; NULL keys are equal here."""
    key = F.struct(*keys)
    keyed = side.select(key.alias("_key"), *[c for c in side.columns if c not in keys])
    return lookup_join(fact.withColumn("_key", key), keyed, "_key", how, limit=limit).drop("_key")


def top_pairs(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str], k: int) -> DataFrame:
    """First k rows of all (left, right) pairs in (left_order, right_order) order.

    A pair within the first k can only use the first k rows of either side, so
    both sides are cut to k by a distributed top-k first. The at most k*k
    candidates then meet through their rank: no product of the tables.
    """
    first = left.orderBy(*left_order).limit(k)
    second = right.orderBy(*right_order).limit(k)
    slots = first.withColumn("_slot", F.explode(F.sequence(F.lit(1), F.lit(k))))
    ranked = second.withColumn("_slot", F.row_number().over(W.orderBy(*right_order)))
    return slots.join(ranked, "_slot").drop("_slot").orderBy(*left_order, *right_order).limit(k)


def lookup(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of `df` whose key is in `ids`; ids without a row are simply absent."""
    wanted = ids.select(key).distinct().withColumn("_wanted", F.lit(True))
    return lookup_join(df, wanted, key, "inner").drop("_wanted")


def prefixed(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """All columns but the key renamed with a prefix."""
    return df.select(key, *[F.col(c).alias(prefix + c) for c in df.columns if c != key])


def left_with_defaults(base: DataFrame, side: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Left join with a default for every listed column that stays NULL."""
    joined = lookup_join(base, side, key)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def tagged_union(column: str, parts: Mapping[str, DataFrame]) -> DataFrame:
    """Bag union of named parts with the name as a column."""
    result = None
    for name, part in parts.items():
        part = part.withColumn(column, F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key. An aggregate, not a window: each task ships at most
    one row per key, so a hot key costs nothing extra."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_r")).select("_r.*")


def newest(df: DataFrame, time: str, tie: str, k: int) -> DataFrame:
    """First page of a newest-first listing."""
    return df.orderBy(F.col(time).desc(), F.col(tie).desc()).limit(k)


def period_counts(df: DataFrame, by: Sequence[str], period: Column, name: str = "period") -> DataFrame:
    return df.groupBy(*by, period.alias(name)).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------- range join

# Pairs up to which one task makes those of a (key, time bucket) cell.
CELL_PAIRS = 4_000_000


def _range_cells(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, within: float | None) -> tuple[DataFrame, DataFrame]:
    """Both sides as (keys, _bucket, _t, row). A left row looks into its own bucket and the one before."""
    known = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    l_t, r_t = (F.unix_micros(F.col(c).cast("timestamp")) for c in (left_time, right_time))
    if within is None:
        buckets, bucket = F.array(F.lit(0).cast("long")), F.lit(0).cast("long")
    else:
        width = F.lit(max(int(within * 1_000_000), 1))
        here = F.floor(F.col("_t") / width)
        buckets, bucket = F.array(here, here - 1), here
    a = left.where(known).select(*keys, l_t.alias("_t"), F.struct(*left.columns).alias("_left")).where("_t IS NOT NULL")
    b = right.where(known).select(*keys, r_t.alias("_u"), F.struct(*right.columns).alias("_right")).where("_u IS NOT NULL")
    return a.withColumn("_bucket", F.explode(buckets)), b.withColumn("_t", F.col("_u")).withColumn("_bucket", bucket).drop("_t")


def range_cells(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, within: float | None = None) -> DataFrame:
    """(keys, _bucket, n_left, n_right) of the cells in which both sides have rows. The sum of n_left * n_right is how many pairs
    a range join looks at, and never less than it returns; counted before any pair is made."""
    a, b = _range_cells(left, right, keys, left_time, right_time, within)
    by = [*keys, "_bucket"]
    return a.groupBy(*by).agg(F.count(F.lit(1)).alias("n_left")).join(b.groupBy(*by).agg(F.count(F.lit(1)).alias("n_right")), by)


def range_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, within: float | None = None,
               most_pairs: int | None = None, cell_pairs: int = CELL_PAIRS) -> DataFrame:
    """(_left, _right) of every pair with equal keys and right time at or before left time, less than `within` seconds before it
    (None: any time before). Rows whose key or time is NULL are in no pair, as in SQL.

    The join is by (key, time bucket of `within` seconds). A cell with more than `cell_pairs` candidate pairs is dealt into a grid
    over both sides, so that a hot key is the work of many tasks. More than `most_pairs` candidate pairs are an error, raised before any
    is made: totals over all earlier rows come cheaper from `ordered.history_totals`.
    """
    a, b = _range_cells(left, right, keys, left_time, right_time, within)
    cells = range_cells(left, right, keys, left_time, right_time, within).withColumn("_pairs", F.col("n_left") * F.col("n_right"))
    total, hot = cells.agg(F.sum("_pairs"), F.count(F.when(F.col("_pairs") > cell_pairs, 1))).first()
    if most_pairs is not None and (total or 0) > most_pairs:
        raise ValueError(f"{total} candidate pairs, more than {most_pairs}")
    by = [*keys, "_bucket"]
    if hot:
        # Columns and rows of the grid, in proportion to the sides; an n x m cell becomes parts of about `cell_pairs`.
        parts = F.col("_pairs") / cell_pairs
        across = F.least(F.greatest(F.ceil(F.sqrt(parts * F.col("n_left") / F.col("n_right"))), F.lit(1)), F.col("n_left"))
        grid = cells.where(F.col("_pairs") > cell_pairs).select(*by, across.cast("int").alias("_rows"), F.least(F.ceil(parts / across), F.col("n_right")).cast("int").alias("_cols"))
        a, b = (lookup_join_by(side, grid, by) for side in (a.withColumn("_at", F.xxhash64("_left")), b.withColumn("_at", F.xxhash64("_right"))))
        one = F.lit(1)
        own = lambda n: F.pmod(F.col("_at"), F.coalesce(n, one)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), one) - 1))
        a = a.withColumn("_i", own(F.col("_rows"))).withColumn("_j", every("_cols"))
        b = b.withColumn("_j", own(F.col("_cols"))).withColumn("_i", every("_rows"))
        by = [*by, "_i", "_j"]
    near = F.col("_u") <= F.col("_t")
    if within is not None:
        near &= F.col("_u") > F.col("_t") - int(within * 1_000_000)
    return a.select(*by, "_t", "_left").join(b.select(*by, "_u", "_right"), by).where(near).select("_left", "_right")
