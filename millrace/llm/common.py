"""Words, word hashes and n-gram hashes of Arrow text columns, vectorised over bytes.

A word is a maximal run of bytes other than blank and 0x09-0x0D; as UTF-8 never
uses these bytes inside a longer character, this is the pattern
``[^\\x20\\x09-\\x0D]+`` on code points. Hashes have 64 bits: a sum of random numbers
per byte times random numbers per place, mixed; every place of an item of any length has
a number of its own. Texts are taken in slices of a few megabytes, so memory
follows the longest text and not the batch.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 2_000_000
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _drawn(place: np.ndarray) -> np.ndarray:
    return mix((place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_PLACES = _drawn(np.arange(4096))  # the most used ones, drawn once


def place_values(place: np.ndarray) -> np.ndarray:
    """The odd number that each place within an item is weighted with."""
    far = np.flatnonzero(place >= len(_PLACES))
    if not len(far):
        return _PLACES[place]
    value = _PLACES[np.minimum(place, len(_PLACES) - 1)]
    value[far] = _drawn(place[far])
    return value


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n+1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes, or of one longer row."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Words:
    """The words of consecutive texts: byte range, row and, on demand, hash. `space` says which
    bytes are in no word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
        self.data, self.offsets, self.blank = data, offsets, space
        n = len(data)
        self.space = space[data]
        before = np.ones(n, bool)
        before[1:] = self.space[:-1]
        begins = offsets[:-1][offsets[:-1] < n]
        before[begins] = True
        self.start = np.flatnonzero(~self.space & before)
        after = np.ones(n, bool)
        after[:-1] = self.space[1:]
        after[begins[begins > 0] - 1] = True
        self.end = np.flatnonzero(~self.space & after) + 1
        self.bounds = np.searchsorted(self.start, offsets)  # word number at which each row begins
        self.count = np.diff(self.bounds)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, fold: np.ndarray | None = None, drop: np.ndarray | None = None) -> np.ndarray:
        """One hash per word, after mapping bytes by `fold` and leaving out those in `drop`."""
        if not len(self):
            return np.zeros(0, np.uint64)
        table = _BYTE if fold is None else _BYTE[fold]
        table = np.where(self.blank, np.uint64(0), table)
        if drop is not None:
            table = np.where(drop, np.uint64(0), table)
        if drop is None:
            place = np.arange(len(self.data), dtype=np.int32)
            first = np.zeros(len(self.data), np.int32)
            first[self.start] = self.start
            place -= np.maximum.accumulate(first)
        else:
            stays = table[self.data] != 0
            kept = np.cumsum(stays, dtype=np.int32) - stays  # kept bytes before each byte
            first = np.zeros(len(self.data), np.int32)
            first[self.start] = kept[self.start]
            place = kept - np.maximum.accumulate(first)
        value = table[self.data] * place_values(place)
        return mix(np.add.reduceat(value, self.start))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash of the n words from each position on; the last n-1 positions
    are left out. Built by doubling: a window is two half windows."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    known, size, done, out = words, 1, 0, None
    rest, step = n, int(_STEP)
    while True:
        if rest & 1:
            if out is None:
                out, done = known, size
            else:  # what is built so far, followed by a window of `size`
                shift = np.uint64(pow(int(_STEP), size, 2**64))
                m = len(words) - (done + size) + 1
                out = out[:m] * shift + known[done : done + m]
                done += size
        rest >>= 1
        if not rest:
            return mix(out)
        m = len(known) - size
        known = known[:m] * np.uint64(step) + known[size : size + m]
        step, size = step * step % 2**64, size * 2


def whole_windows(row: np.ndarray, n: int) -> np.ndarray:
    """Which of the windows of n words lie in one row."""
    if len(row) < n:
        return np.zeros(0, bool)
    return row[: len(row) - n + 1] == row[n - 1 :]


def shingle_rows(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every n-word shingle; a text of fewer words is one shingle."""
    grams = ngram_hashes(hashes, n)
    whole = whole_windows(words.row, n)
    short = np.flatnonzero((words.count > 0) & (words.count < n))
    extra = np.array([_sequence(hashes[words.bounds[r] : words.bounds[r + 1]]) for r in short], np.uint64)
    row = np.concatenate([words.row[: len(grams)][whole], short])
    value = np.concatenate([grams[whole], extra])
    if len(short):
        order = np.argsort(row, kind="stable")
        row, value = row[order], value[order]
    return value, row


def _sequence(hashes: np.ndarray) -> int:
    value = len(hashes)
    for h in hashes.tolist():
        value = (value * int(_STEP) + h) % 2**64
    return int(mix(np.array([value], np.uint64))[0])


def crc_fold(column: Column, folds: int) -> Column:
    """crc32 of the value as text, modulo `folds`; a null value counts as empty text."""
    return (F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def ranges_to_bytes(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions covered by ranges, in order."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) + np.repeat(start - (ends - length), length)


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Least of the n values from each position on."""
    known, size = x, 1
    while size * 2 <= n:
        known = np.minimum(known[: len(known) - size], known[size:])
        size *= 2
    m = len(x) - n + 1
    return np.minimum(known[:m], known[n - size : n - size + m])


def runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run; `breaks` marks the first item of a run."""
    first = np.flatnonzero(breaks)
    return first, np.diff(np.append(first, len(breaks)))


def whole_row(df) -> Column:
    """All columns as one, so that names of ours cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def keyed(docs, id_col: str = "doc_id", text_col: str = "text", **more: Column):
    """(doc, tag, text): the id with null as the largest number, a hash that tells
    rows of one id apart, and the text; then `more` (name = column). Other columns do
    not get in the way."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *[c.alias(name) for name, c in more.items()],
    )


NO_ID = 2**63 - 1


def given_id(name: str = "doc") -> Column:
    """The id as it was given."""
    return F.when(F.col(name) != NO_ID, F.col(name))


def partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def share(spark, obj):
    """Broadcast an object, its classes included; returns a function that gives an executor its own."""
    state = spark.sparkContext.broadcast(cloudpickle.dumps(obj))

    def get():
        return pickle.loads(state.value)

    return get


def grouped(fn: Callable[[pa.Table], pa.RecordBatch | None], keys: list[str]):
    """Apply `fn` to each group of rows that are equal in `keys`; input is sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [batch[k].to_numpy() for k in keys]
            new = np.append(True, np.any([x[1:] != x[:-1] for x in ids], axis=0))
            for first, size in zip(*runs(new), strict=True):
                key = tuple(x[first] for x in ids)
                if held and key != current:
                    out = fn(pa.Table.from_batches(held).combine_chunks())
                    if out is not None:
                        yield out
                    held = []
                held.append(batch.slice(first, size))
                current = key
        if held and (out := fn(pa.Table.from_batches(held).combine_chunks())) is not None:
            yield out

    return run
