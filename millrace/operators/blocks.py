"""Pairs of neighbouring terms of many documents, in blocks.

A block holds the terms of some documents as codes, places in the sorted list of its different terms. So a pair is one number, and pairs in
the order of their numbers are in the order of their phrases.

In how many documents a pair stands is asked for and answered by block: a block sends each of its different pairs once, with the number of its documents
that hold it, to slices of the range of hashes, and gets back the sums in the order sent. No text of a pair is moved, and what is moved follows the
size of the table, whatever its pairs have in common. A pair is known there by 104 bits or more: the odds that any two of two thousand million different
ones are taken for one are below 10^-12.
"""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Terms of a block, and pairs that meet in a slice, both about; slices are 2 ^ LEAST_BITS or more.
BLOCK_TERMS, SLICE_PAIRS, LEAST_BITS = 1 << 19, 1 << 19, 8
_NEAR = 2e-6  # scores are rounded to six places
_FACTORS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of that many rows in what is run meanwhile: for tables with large rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def pieces(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of these sizes with a sum of at most `most`, or of one larger row."""
    end, first = np.cumsum(size), 0
    while first < len(size):
        last = int(np.searchsorted(end, (end[first - 1] if first else 0) + most, "right"))
        yield first, (last := max(last, first + 1))
        first = last


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2 ^ 32, first the low bytes of all: small ones compress well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


_CODED = "block long, n long, ids array<{kind}>, sizes binary, words binary, codes binary"


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block: its number, how many terms it has, document ids, their numbers of terms, the different terms in order, and the code of each term."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        size = pc.list_value_length(batch["terms"]).to_numpy(zero_copy_only=False).astype(np.int64)
        for first, last in pieces(size, BLOCK_TERMS):
            ids, terms = (batch[c].slice(first, last - first) for c in ("id", "terms"))
            coded = pc.dictionary_encode(terms.flatten())
            order = pc.sort_indices(coded.dictionary)
            rank = np.empty(len(order), np.int64)
            rank[order.to_numpy()] = np.arange(len(order))
            columns = {"block": pa.array([number], pa.int64()), "n": pa.array([int(size[first:last].sum())], pa.int64()), "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)}
            words = "\n".join(coded.dictionary.take(order).to_pylist()).encode()  # terms are letters
            for name, raw in (("sizes", _planes(size[first:last])), ("words", words), ("codes", _planes(rank[coded.indices.to_numpy()]))):
                columns[name] = pa.array([zlib.compress(raw, 1)], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)
            number += 1


class _Pairs:
    """The pairs of a block: `pair` the different ones in order, `row`, `at` and `n` the document, the place in `pair` and the number of each
    pair of each document, `df` in how many of its documents a pair stands."""

    def __init__(self, sizes: bytes, words: bytes, codes: bytes):
        size, code = (_unplaned(zlib.decompress(x)) for x in (sizes, codes))
        self.words = zlib.decompress(words).decode().split("\n")
        self.many = len(self.words)
        rows = np.repeat(np.arange(len(size)), size)
        place = np.flatnonzero(rows[1:] == rows[:-1])
        self.pair, at = np.unique(code[place] * self.many + code[place + 1], return_inverse=True)
        key, self.n = np.unique(rows[place] * max(len(self.pair), 1) + at, return_counts=True)
        self.row, self.at = np.divmod(key, max(len(self.pair), 1))
        self.df = np.bincount(self.at, minlength=len(self.pair))

    def phrases(self, at: np.ndarray) -> pa.Array:
        words = pa.array(self.words, pa.string())
        return pc.binary_join_element_wise(*(words.take(pa.array(x)) for x in np.divmod(self.pair[at], self.many)), " ")

    def keys(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of the pairs in the order of their keys, where each of the 2 ^ `bits` slices begins, and 32 and 64 more bits of each."""
        known = np.frombuffer(b"".join(hashlib.blake2b(w.encode(), digest_size=16).digest() for w in self.words), np.uint64).reshape(-1, 2)
        a, b = np.divmod(self.pair, self.many)
        near, far = (_mixed(known[a, i] * _FACTORS[i] + known[b, i]) for i in range(2))
        near >>= np.uint64(32 - bits)
        order = np.argsort(near, kind="stable")
        near = near[order]
        begin = np.searchsorted(near, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
        return order, begin, (near & np.uint64(0xFFFFFFFF)).astype(np.uint32), far[order]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _FACTORS[1]
    return x ^ (x >> np.uint64(32))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, _Pairs]]:
    for i in range(batch.num_rows):
        yield i, _Pairs(*(batch[c][i].as_py() for c in ("sizes", "words", "codes")))


def _asked(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, pairs in _blocks(batch):
                order, begin, low, far = pairs.keys(bits)
                full, df = np.flatnonzero(np.diff(begin)), pairs.df[order]
                own = lambda x: pa.BinaryArray.from_buffers(pa.binary(), len(full), [None, pa.py_buffer((np.append(begin[full], begin[-1]) * x.itemsize).astype(np.int32)), pa.py_buffer(x)])  # noqa: B023, E731
                columns = {"block": pa.array([batch["block"][i].as_py()] * len(full), pa.int64()), "slice": pa.array(full.astype(np.int32)), "low": own(low), "far": own(far),
                           "df": pa.array([_planes(df[begin[s] : begin[s + 1]]) for s in full], pa.binary())}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _answered(table: pa.Table) -> pa.Table:
    """The sums over all blocks of the documents that hold each pair of a slice."""
    low, far, df = [np.frombuffer(x, np.uint32) for x in table["low"].to_pylist()], [np.frombuffer(x, np.uint64) for x in table["far"].to_pylist()], [_unplaned(x) for x in table["df"].to_pylist()]
    ends = np.cumsum([len(x) for x in low])[:-1]
    low, far, df = map(np.concatenate, (low, far, df))
    order = np.lexsort((far, low))
    low, far = low[order], far[order]
    group = np.cumsum(np.append(False, (low[1:] != low[:-1]) | (far[1:] != far[:-1])))
    sums = np.empty(len(df), np.int64)
    sums[order] = np.bincount(group, df[order]).astype(np.int64)[group]
    return pa.table({"block": table["block"], "slice": table["slice"], "df": pa.array([_planes(x) for x in np.split(sums, ends)], pa.binary())})


def _best(pairs: _Pairs, df: np.ndarray, k: int, total: int) -> np.ndarray:
    """The k best pairs of each document by n * ln((total + 1) / (df + 1)), and those that may be among them after rounding."""
    score = pairs.n * np.log((total + 1) / (df + 1.0))[pairs.at]
    order = np.lexsort((pairs.at, -score, pairs.row))
    row, score, place = pairs.row[order], score[order], np.arange(len(order))
    rank = place - np.searchsorted(row, row)
    least = np.full(len(row) and int(row[-1]) + 1, -np.inf)
    least[row[rank == k - 1]] = score[rank == k - 1]
    begins = np.append(True, (row[1:] != row[:-1]) | (score[1:] != score[:-1]))[: len(row)]
    equal = place - np.maximum.accumulate(np.where(begins, place, 0))  # how many of the same score are ahead
    return order[(score >= least[row] - _NEAR) & (equal < k)]


def _leading(bits: int, k: int, total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, pairs in _blocks(batch):
                order, begin, _, _ = pairs.keys(bits)
                df = np.zeros(len(order), np.int64)
                for answer in batch["answers"][i].as_py() or ():
                    df[order[begin[answer["slice"]] : begin[answer["slice"] + 1]]] = _unplaned(answer["df"])
                best = _best(pairs, df, k, total)
                at = pairs.at[best]
                yield pa.RecordBatch.from_pydict({"id": batch["ids"].slice(i, 1).flatten().take(pa.array(pairs.row[best])), "phrase": pairs.phrases(at), "n": pa.array(pairs.n[best]), "df": pa.array(df[at])})

    return run


def leading_pairs(docs: DataFrame, terms: str, k: int, total: int, doc_id: str) -> DataFrame:
    """A stored table of (id, phrase, n, df): the k pairs of neighbouring `terms` (letters) of each row with the highest n * ln((total + 1) / (df + 1)), in the order
    of their phrases on ties, and those that may be among them after rounding to six places. `df` counts the rows that hold the pair."""
    spark, kind = docs.sparkSession, docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("id"), F.col(terms).alias("terms")).where(F.size("terms") > 1)
    stored = written(rows.mapInArrow(_coded, _CODED.format(kind=kind)), "blocks")
    many = stored.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(max((many // SLICE_PAIRS).bit_length(), LEAST_BITS), 24)
    asked = stored.mapInArrow(_asked(bits), "block long, slice int, low binary, far binary, df binary")
    answers = asked.groupBy("slice").applyInArrow(_answered, "block long, slice int, df binary")
    gathered = answers.groupBy("block").agg(F.collect_list(F.struct("slice", "df")).alias("answers"))
    with batches_of(spark, 1):  # a row is a block
        return written(stored.join(gathered, "block", "left").mapInArrow(_leading(bits, k, total), f"id {kind}, phrase string, n long, df long"), "leading")
