"""Phrases of any length, mined by rounds.

A phrase can only be frequent if the phrases of one word less within it are. So round L counts, of all runs of L terms,
those whose first and last L - 1 terms may be frequent. Terms stay with their document, in order: a round gets the frequent
runs of the round before as a broadcast bitmap of their hashes, of bounded size, which may let too many runs pass, but never too few.
Only runs and their counts are shuffled, added up by batch and by task before, and they are counted by their text, so
that hashes decide on no result.

A phrase that nearly always stands within one longer phrase is part of that one: `whole` leaves it out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators.blocks import batches_of, pieces
from millrace.operators.relational import BROADCAST_ROWS, lookup_join
from millrace.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bits of a bitmap: so many a run, within these limits.
BITS, LEAST_BITS, MOST_BITS = 32, 1 << 16, 1 << 28
# Terms that are counted at once, and rows that are handed over at once.
PIECE_TERMS, ROWS = 1 << 18, 256
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _run_hashes(term: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` terms from each place on; places too near to the end keep fewer."""
    out = term.copy()
    for j in range(1, length):
        out[: len(out) - j] = out[: len(out) - j] * _FACTOR + term[j:]
    return out ^ (out >> np.uint64(29))


def _flat(batch: pa.RecordBatch) -> tuple:
    """Terms of all rows end to end, their hashes, and the row of each."""
    size = pc.list_value_length(batch["terms"]).to_numpy(zero_copy_only=False)
    return batch["terms"].flatten(), batch["hashes"].flatten().to_numpy().view(np.uint64), np.repeat(np.arange(len(size)), size)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `PIECE_TERMS` terms, or of one longer row: the memory of a task does not follow the lengths of its texts."""
    for batch in batches:
        size = pc.list_value_length(batch["terms"]).to_numpy(zero_copy_only=False)
        for first, last in pieces(size, PIECE_TERMS):
            yield batch.slice(first, last - first)


def _set(bitmap: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    at = hashed & np.uint64(64 * len(bitmap) - 1)
    return (bitmap.take((at >> np.uint64(6)).astype(np.int64)) >> (at & np.uint64(63))) & np.uint64(1) > 0


def _counted(length: int, bitmap=None, of: int = 0, doc: str | None = None):
    """Runs of `length` terms whose runs of `of` terms are all in the bitmap, with their counts in the batch; with `doc`, by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            terms, term, row = _flat(batch)
            places = max(len(term) - length + 1, 0)
            ok = row[:places] == row[length - 1 :]
            if bitmap is not None:
                known = _set(bitmap.value, _run_hashes(term, of))
                for j in range(length - of + 1):
                    ok &= known[j : j + places]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            key = _run_hashes(term, length)[at]
            if doc:
                key = (key + row[at].astype(np.uint64)) * _FACTOR
            _, first, which, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            code = pc.dictionary_encode(terms).indices.to_numpy()
            same = at[first][which]
            if any((code[at + j] != code[same + j]).any() for j in range(length)) or (doc and (row[at] != row[same]).any()):
                # Two runs share a hash: they are told apart by their terms.
                _, first, n = np.unique(np.column_stack([row[at] if doc else np.zeros(len(at)), *(code[at + j] for j in range(length))]), axis=0, return_index=True, return_counts=True)
            at = at[first]
            phrase = pc.binary_join_element_wise(*(terms.take(pa.array(at + j)) for j in range(length)), " ")
            columns = {"phrase": phrase, "n": pa.array(n.astype(np.int64))}
            yield pa.RecordBatch.from_pydict({doc: batch[doc].take(pa.array(row[at])), **columns} if doc else columns)

    return run


def _positions(length: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _run_hashes(_flat(batch)[1], length)[::length] & np.uint64(bits - 1)  # each row has one run
            yield pa.RecordBatch.from_pydict({"at": pa.array(at.astype(np.int64))})

    return run


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("hashes", F.transform("terms", lambda t: F.xxhash64(t)))


def _bitmap(counts: DataFrame, length: int):
    """Broadcast bitmap of the hashes of these runs of `length` terms."""
    bits = min(max(1 << (BITS * counts.count()).bit_length(), LEAST_BITS), MOST_BITS)
    runs = _hashed(counts.select(F.split("phrase", " ").alias("terms")))
    at = runs.mapInArrow(_positions(length, bits), "at long")
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("set"))
    out = np.zeros(bits // 64, np.uint64)
    for r in words.toLocalIterator():  # bits / 64 words at most
        out[r.word] = np.int64(r.set).view(np.uint64)
    return counts.sparkSession.sparkContext.broadcast(out)


def mined(docs: DataFrame, least: int = 10, longest: int = 6, doc_id: str = "doc_id", text: str = "text", limit: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """(phrase, length, n, significance) of every run of 2 to `longest` terms that occurs `least` times or more, and where they
    occur: (doc_id, phrase, n).

    `significance` is how many standard deviations n is above the count to expect if the last term came by chance after the others."""
    listed = docs.select(doc_id, tx.terms(F.col(text)).alias("terms")).where(F.size("terms") > 0)
    stored = written(listed, "terms")
    total = stored.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).scalar()
    live, kind = _hashed(stored), docs.schema[doc_id].dataType.simpleString()
    found, places, shorter, bitmap = None, None, None, None
    for length in range(1, longest + 1):
        runs = live.mapInArrow(_counted(length, bitmap, length - 1), "phrase string, n long")
        with batches_of(docs.sparkSession, ROWS):
            counts = written(runs.groupBy("phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "frequent")
        if not counts.limit(1).count():
            break
        bitmap = _bitmap(counts, length)
        if length == 1:
            words = counts.select(F.col("phrase").alias("_last"), F.col("n").alias("_n_last"))
        else:
            begin = F.substring_index("phrase", " ", length - 1)
            judged = counts.join(shorter, begin == F.col("_begin")).join(words, F.substring_index("phrase", " ", -1) == F.col("_last"))
            expected = F.col("_n_begin") * F.col("_n_last") / F.lit(total)
            row = judged.select("phrase", F.lit(length).alias("length"), "n", F.round((F.col("n") - expected) / F.sqrt(F.col("n")), 6).alias("significance"))
            found = row if found is None else found.unionByName(row)
            near = live.mapInArrow(_counted(length, bitmap, length, doc_id), f"`{doc_id}` {kind}, phrase string, n long")
            own = lookup_join(near, counts.select("phrase", F.col("n").alias("_n")), "phrase", "inner", limit=limit, spread_by=[doc_id], size="_n").drop("_n")
            places = own if places is None else places.unionByName(own)
        shorter = counts.select(F.col("phrase").alias("_begin"), F.col("n").alias("_n_begin"))
    if found is None:
        schema = "phrase string, length int, n long, significance double"
        return docs.sparkSession.createDataFrame([], schema), docs.select(doc_id, F.lit("").alias("phrase"), F.lit(0).cast("long").alias("n")).limit(0)
    return written(found, "phrases"), places


def whole(phrases: DataFrame, share: float = 0.8, least_significance: float = 2.0) -> DataFrame:
    """Significant phrases, without those of which `share` of all occurrences or more lie within one phrase that is a term longer."""
    longer = phrases.where("length > 2").select(
        F.explode(F.array_distinct(F.array(F.regexp_replace("phrase", " [^ ]+$", ""), F.regexp_replace("phrase", "^[^ ]+ ", "")))).alias("phrase"), F.col("n").alias("_n"))
    most = longer.groupBy("phrase").agg(F.max("_n").alias("_most"))
    kept = phrases.join(most, "phrase", "left").where(F.coalesce("_most", F.lit(0)) < share * F.col("n"))
    return kept.where(F.col("significance") >= least_significance).drop("_most")


def leading_phrases(docs: DataFrame, k: int = 12, doc_id: str = "doc_id", limit: int = BROADCAST_ROWS, **settings) -> DataFrame:
    """(doc_id, rank, phrase, score): the k whole phrases of each document with the highest TF-IDF, phrase order on ties."""
    phrases, places = mined(docs, doc_id=doc_id, limit=limit, **settings)
    spread = places.groupBy("phrase").agg(F.countDistinct(doc_id).alias("_df"))
    side = written(whole(phrases).select("phrase").join(spread, "phrase"), "whole")
    total = docs.agg(F.count(F.lit(1))).scalar()
    scored = lookup_join(places, side, "phrase", "inner", limit=limit, spread_by=[doc_id])
    scored = scored.select(doc_id, "phrase", F.round(F.col("n") * F.ln((total + 1) / (F.col("_df") + 1)), 6).alias("score"))
    order = W.partitionBy(doc_id).orderBy(F.col("score").desc(), "phrase")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(doc_id, "rank", "phrase", "score")
