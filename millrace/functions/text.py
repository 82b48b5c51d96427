"""String, path and JSON expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Every character the whitespace split of a text counts as blank.
BLANKS = r"[\t\n\x0B\f\r\x1c-\x1f\x85\p{Z}]+"

# Fixed value: a name's title stands after a blank and before a full stop.
TITLE_PATTERN = r" ([A-Za-z]+)\."


def words(text: Column) -> Column:
    """Words of the whole text, split on any run of blanks."""
    return F.filter(F.split(text, BLANKS), lambda w: w != F.lit(""))


def word_count(text: Column) -> Column:
    return F.size(words(text))


def terms(text: Column) -> Column:
    """Lower-case runs of letters, for lexicon and phrase statistics."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def runs(items: str) -> Column:
    """(item, n) pairs of a SORTED array column: each run of equal items counted
    within its row, so no shuffle has to bring a document's items together."""
    a, n = F.col(items), F.size(items)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(a, i) != F.get(a, i - 1)))
    ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n))
    pairs = F.zip_with(starts, ends, lambda s, e: F.struct(F.get(a, s).alias("item"), (e - s).cast("bigint").alias("n")))
    return F.when(n > 0, pairs)


def segments(text: Column, size: int = 5000) -> Column:
    """The whole text as consecutive pieces of at most `size` characters, for
    scorers with an input limit; nothing is cut off."""
    count = F.greatest(F.ceil(F.length(text) / F.lit(size)).cast("int"), F.lit(1))
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.substring(text, i * F.lit(size) + 1, F.lit(size)),
    )


def title_of(name: Column) -> Column:
    """Title in a person's name, NULL when there is none."""
    return F.nullif(F.regexp_extract(name, TITLE_PATTERN, 1), F.lit(""))


def basename(path: Column) -> Column:
    """Part after the last slash."""
    return F.substring_index(path, "/", -1)


def strip_extension(path: Column) -> Column:
    """Drop the part from the last full stop on, wherever it stands."""
    return F.regexp_replace(path, r"\.[^.]*$", "")


def extension(path: Column) -> Column:
    """Suffix of the last path segment without its dot, NULL when there is none."""
    return F.nullif(F.regexp_extract(basename(path), r"\.([^.]*)$", 1), F.lit(""))


def derived_path(path: Column, old: str, new: str, suffix: str) -> Column:
    """Output key next to an input key: folder swapped, extension replaced."""
    return F.concat(strip_extension(F.replace(path, F.lit(old), F.lit(new))), F.lit(suffix))


def parse_score(raw: Column) -> Column:
    """Number out of `0.78` or `[0.78]`; NULL when it is none."""
    return F.btrim(raw, F.lit("[]")).try_cast("double")


def csv_payload(cols: Sequence[Column]) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in cols])


def parse_payload(raw: Column, names: Sequence[str]) -> Column:
    """CSV payload to a struct of doubles; a bad or missing value gives NULL."""
    parts = F.split(raw, ",")
    return F.struct(
        *[F.btrim(F.get(parts, F.lit(i))).try_cast("double").alias(n) for i, n in enumerate(names)]
    )


def table_name(group: Column) -> Column:
    """Catalogue name of a feature group."""
    return F.translate(group, "-", "_")


def json_field(doc: Column, path: str, kind: str, default=None) -> Column:
    """Typed value at a JSON path, `default` when absent or of another type."""
    value = F.get_json_object(doc, path).try_cast(kind)
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))


def records_to_map(records: Column) -> Column:
    """(FeatureName, ValueAsString) pairs to a map; the pairs name a feature once."""
    return F.map_from_entries(records)


def to_records(cols: Sequence[str]) -> Column:
    """The listed columns as (FeatureName, ValueAsString) pairs."""
    return F.array(
        *[
            F.struct(F.lit(c).alias("FeatureName"), F.col(c).cast("string").alias("ValueAsString"))
            for c in cols
        ]
    )
