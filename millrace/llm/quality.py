"""Repetition coverage: how much of a text lies inside repeated n-grams and lines.

Rolling hashes of 3, 5 and 10 words and of whole lines are taken for many texts at once
with numpy. A word is covered by a length n if it lies in an n-word window found twice or
more in its text, the first included; coverage counts the characters of covered words.
Texts are judged row by row where they are read, so nothing is shuffled.

Defined results: a null or blank text has no words and fails; repeated rows give equal
results; a line is compared as it stands, without its line feed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import Words, _BYTE, mix, ngram_hashes, place_values, runs, slices, text_buffers, whole_windows

# Largest shares of a text's word characters inside repeated windows of n words (n of
# several lengths) and inside repeated lines that a kept text may have.
MOST_IN_NGRAMS = {5: 0.4, 10: 0.35}
MOST_IN_LINES = 0.4
# Most characters of SYMBOLS for each word.
MOST_SYMBOLS = 0.2
LEAST_WORDS, BASE_N, BASE_PERCENT = 50, 3, 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_SALT = np.uint64(0x9E3779B97F4A7C15)


def repetition(docs: DataFrame, lengths: Sequence[int] = tuple(MOST_IN_NGRAMS), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per document: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    dup_line_chars and, per length n, dup_chars_n."""
    extra = [f"dup_chars_{n}" for n in lengths]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *extra]
    rows = docs.selectExpr(f"CAST(`{id_col}` AS long) AS doc_id", f"`{text_col}` AS text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets):
                found = measure(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lengths)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), *[pa.array(x.astype(np.int64)) for x in found]], names)

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return total[bounds[1:]] - total[bounds[:-1]]


def _copies(value: np.ndarray, row: np.ndarray, first_too: bool) -> np.ndarray:
    """Which values occur more than once in their row; without the first unless `first_too`."""
    key = mix(value ^ (row.astype(np.uint64) * _SALT))
    order = np.argsort(key) if first_too else np.argsort(key, kind="stable")
    k = key[order]
    first, size = runs(np.append(True, k[1:] != k[:-1]))
    out = np.zeros(len(key), bool)
    many = np.repeat(size > 1, size)
    if not first_too:
        many[first] = False
    out[order[many]] = True
    return out


def covered(words: Words, hashes: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in an n-word window that its row holds twice or more."""
    at = np.flatnonzero(whole_windows(words.row, n))
    depth = np.zeros(len(words) + n + 1, np.int32)
    if len(at):
        again = at[_copies(ngram_hashes(hashes, n)[at], words.row[at], True)]
        depth[again] += 1
        depth[again + n] -= 1
    return np.cumsum(depth[: len(words)]) > 0


def measure(data: np.ndarray, offsets: np.ndarray, lengths: Sequence[int]) -> list[np.ndarray]:
    words = Words(data, offsets)
    hashes = words.hashes()
    head = (data & 0xC0) != 0x80  # first byte of a character
    in_word = head & ~words.space
    before = np.append(0, np.cumsum(in_word, dtype=np.int64))
    chars = before[words.end] - before[words.start]
    lines, line_chars = _repeated_lines(data, offsets, before)
    out = [words.count, before[offsets[1:]] - before[offsets[:-1]], _sums(SYMBOLS[data], offsets), lines]
    base = covered(words, hashes, BASE_N)
    out += [_sums(base, words.bounds), line_chars]
    return out + [_sums(np.where(covered(words, hashes, n), chars, 0), words.bounds) for n in lengths]


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line of their row: number and word characters."""
    feed = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([offsets[:-1], feed + 1]))
    start = start[start < len(data)]
    n = len(offsets) - 1
    if not len(start):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    end = np.append(start[1:], len(data))
    row = np.searchsorted(offsets, start, "right") - 1
    size = end - start
    value = _BYTE[data] * place_values(np.arange(len(data)) - np.repeat(start, size))
    value[feed] = 0
    line = mix(np.add.reduceat(value, start))
    chars = before[end] - before[start]
    full = np.flatnonzero(chars > 0)
    again = full[_copies(line[full], row[full], False)] if len(full) else full
    return np.bincount(row[again], minlength=n), np.bincount(row[again], weights=chars[again], minlength=n).astype(np.int64)


def judged(counts: DataFrame) -> DataFrame:
    """Adds base_failed and kept to the counts of `repetition`."""
    limits = " AND ".join(f"dup_chars_{n} <= {share} * word_chars" for n, share in MOST_IN_NGRAMS.items())
    base = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {BASE_PERCENT} * n_words"
    return counts.selectExpr("*", f"({base}) AS base_failed", f"(NOT ({base}) AND {limits} AND dup_line_chars <= {MOST_IN_LINES} * word_chars AND n_symbols <= {MOST_SYMBOLS} * n_words) AS kept")


def query(spark, sf_dir: str) -> DataFrame:
    return judged(repetition(spark.read.parquet(f"{sf_dir}/documents.parquet"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "dup_line_chars", *[f"dup_chars_{n}" for n in MOST_IN_NGRAMS])


def _cover_sql(n: int, value: str) -> str:
    """Per document the sum of `value` over words inside repeated n-word windows."""
    return f"""(SELECT doc_id, sum({value}) AS x FROM (
      SELECT doc_id, word, max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside FROM (
        SELECT doc_id, i, word, CASE WHEN i + {n - 1} <= n AND count(*) OVER (PARTITION BY doc_id, i + {n - 1} <= n, g) > 1 THEN 1 ELSE 0 END AS again FROM (
          SELECT doc_id, i, n, word, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)) AS g FROM p)))
      WHERE inside = 1 GROUP BY 1)"""


SQL = rf"""WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
l AS (SELECT doc_id, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS c, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS nth FROM (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM w))),
dl AS (SELECT doc_id, count(*) AS n, sum(c) AS c FROM l WHERE c > 0 AND nth > 1 GROUP BY 1),
t AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dl.n, 0)::BIGINT AS n_dup_lines,
  coalesce(a.x, 0)::BIGINT AS n_repeat_words, coalesce(dl.c, 0)::BIGINT AS dup_line_chars, coalesce(b.x, 0)::BIGINT AS dup_chars_5, coalesce(c.x, 0)::BIGINT AS dup_chars_10
  FROM w LEFT JOIN dl USING (doc_id) LEFT JOIN {_cover_sql(3, '1')} a USING (doc_id) LEFT JOIN {_cover_sql(5, 'length(word)')} b USING (doc_id) LEFT JOIN {_cover_sql(10, 'length(word)')} c USING (doc_id))
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND dup_chars_5 <= 0.4 * word_chars AND dup_chars_10 <= 0.35 * word_chars AND dup_line_chars <= 0.4 * word_chars AND n_symbols <= 0.2 * n_words) AS kept
FROM t"""
