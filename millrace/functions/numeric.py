"""Arithmetic, encoding and hashing expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def safe_ratio(num: Column, den: Column) -> Column:
    """`num / den`, NULL when the denominator is zero or NULL."""
    return F.try_divide(num, den)


def change_pct(old: Column, new: Column) -> Column:
    """Relative change from `old` to `new` in percent; NULL when `old` is 0 or NULL."""
    return safe_ratio((new - old) * 100.0, old)


def clip(col: Column, lo: float, hi: float) -> Column:
    """Limit to [lo, hi]; NULL stays NULL (least/greatest would skip it)."""
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(lo)), F.lit(hi)))


def scaled(col: Column, factor: float) -> Column:
    return col / F.lit(factor)


def scaled_array(col: Column, factor: float) -> Column:
    return F.transform(col, lambda x: x / F.lit(factor))


def map_encode(col: Column, mapping: Mapping, default=None) -> Column:
    """Dictionary encoding; a value outside the mapping gives `default` (NULL)."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    code = F.try_element_at(table, col)
    return code if default is None else F.coalesce(code, F.lit(default))


def case_encode(col: Column, mapping: Mapping, otherwise) -> Column:
    """CASE encoding; everything outside the mapping, NULL included, gives `otherwise`."""
    (first, code), *rest = mapping.items()
    expr = F.when(col == F.lit(first), F.lit(code))
    for value, code in rest:
        expr = expr.when(col == F.lit(value), F.lit(code))
    return expr.otherwise(F.lit(otherwise))


def collapse(col: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """Replace every listed member by its group's name; other values are kept."""
    synonyms = {member: name for name, members in groups.items() for member in members}
    return F.coalesce(map_encode(col, synonyms), col)


def flag(condition: Column) -> Column:
    """Boolean to 0/1; an unknown condition stays NULL."""
    return condition.cast("int")


def threshold_class(p: Column, cut: float = 0.5) -> Column:
    """1 when p is strictly above the cut."""
    return flag(p > F.lit(cut))


def confidence(p: Column, cut: float = 0.5) -> Column:
    """Probability of the predicted class."""
    return F.when(p > F.lit(cut), p).otherwise(1.0 - p)


def weighted_score(terms: Mapping[str, float]) -> Column:
    """Linear score sum(weight * column)."""
    return reduce(lambda a, b: a + b, [F.col(c) * F.lit(w) for c, w in terms.items()])


def hash_bucket(key: Column, buckets: int, seed: str | int = 0) -> Column:
    """Bucket in [0, buckets) from md5(seed:key): the same on every engine,
    partitioning and run, unlike `rand`."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def dot(a: Column, b: Column) -> Column:
    """Dot product of two numeric arrays, in double."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def millis(seconds: Column) -> Column:
    return seconds * 1000.0


def kilobytes(size: Column) -> Column:
    return size / 1024.0


def megabytes(size: Column) -> Column:
    return size / (1024.0 * 1024.0)
