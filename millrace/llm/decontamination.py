"""Benchmark decontamination by MinHash containment search.

An item is held by a document if at least `percent` of the item's distinct five-word shingles
(A-Z folded) occur in the document, anywhere. Items are small and documents may be long,
so the search sketches the items: the sketch of an item is the shingles with the least hashes
(bottom-k MinHash), and a document is a candidate if it contains one of them. Items are
partitioned by size, each partition with its own k: with q shingles, k = q - ceil(share q) + 1
is enough for certainty, since a document without any of them lacks more than it may; above
`MOST` the sketch stays at `MOST` shingles, which a held item misses altogether with
probability (1 - share)^MOST, below 10^-22 at a share of 0.8.
Candidates are verified on the whole shingle sets in the same pass.

Items are a query set: they are taken in blocks of bounded size, and every document is read
against each block. Documents are not shuffled; only (document, item) results leave a task.

Defined results: items and documents without words take part in nothing; an item of fewer than five
words is one shingle and is held by a text of just these words; rows that repeat an item_id
are one item each; duplicates in the result are removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, Words, given_id, keyed, mix, shingle_rows, slices, text_buffers, whole_row
from millrace.llm.near_dedup import shingle_sets

SHINGLE, PERCENT = 5, 80
BLOCK_ITEMS, BLOCK_BYTES = 50_000, 64 << 20
MOST = 32


class Items:
    """The shingle sets of a block of items and their sketches, sorted for probing."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, shingle: int, percent: int):
        data, offsets = text_buffers(texts)
        self.ids = ids
        value, self.size = shingle_sets(data, offsets, shingle)
        owner = np.repeat(np.arange(len(ids)), self.size)
        # A partition of sizes needs the k of its largest member to be certain for all.
        top = 1 << np.ceil(np.log2(np.maximum(self.size, 1))).astype(np.int64)
        enough = np.array([q - ceil(percent * q / 100) + 1 for q in top.tolist()], np.int64)
        k = np.minimum(np.minimum(enough, MOST), self.size)
        order = np.lexsort((mix(value), owner))
        begin = np.cumsum(self.size) - self.size
        rank = np.arange(len(value)) - np.repeat(begin, self.size)
        self.value, self.owner = _by_value(value, owner)
        picked = order[rank < np.repeat(k, self.size)]
        self.probe, self.probe_owner = _by_value(value[picked], owner[picked])


def _by_value(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(value, kind="stable")
    return value[order], owner[order]


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (index in wanted, index in keys) with equal values; keys are sorted."""
    first, last = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
    n = last - first
    at = np.repeat(np.arange(len(wanted)), n)
    return at, np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def held_items(data: np.ndarray, offsets: np.ndarray, items: Items, shingle: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item index, shared shingles) of the items that the texts hold."""
    words = Words(data, offsets)
    value, row = shingle_rows(words, words.hashes(LOWER), shingle)
    none = np.zeros(0, np.int64)
    if not len(value) or not len(items.probe):
        return none, none, none
    probe = np.unique(items.probe)
    place = np.minimum(np.searchsorted(probe, value), len(probe) - 1)
    hit = np.flatnonzero(probe[place] == value)
    at, key = _lookup(items.probe, value[hit])
    pair = np.unique(row[hit][at] * len(items.ids) + items.probe_owner[key])
    if not len(pair):
        return none, none, none
    # Verify: all shingles of the rows with a candidate against all shingles of the items.
    rows = np.unique(pair // len(items.ids))
    mine = np.isin(row, rows)
    every = np.unique(np.stack([row[mine].astype(np.uint64), value[mine]], axis=1), axis=0)
    at, key = _lookup(items.value, every[:, 1])
    both, shared = np.unique(every[at, 0].astype(np.int64) * len(items.ids) + items.owner[key], return_counts=True)
    enough = np.isin(both, pair) & (100 * shared >= percent * items.size[both % len(items.ids)])
    return both[enough] // len(items.ids), both[enough] % len(items.ids), shared[enough]


def _search(shared, shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value, shingle, percent)
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            doc, tag = batch["doc"].to_numpy(), batch["tag"].to_numpy()
            for a, b in slices(offsets):
                row, item, n = held_items(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], items, shingle, percent)
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc[a:b][row]), pa.array(tag[a:b][row]), pa.array(items.ids[item]), pa.array(n.astype(np.int64)), pa.array(items.size[item])],
                        ["doc", "tag", "item", "n_shared", "n_item"])

    return run


def _item_blocks(rows: DataFrame) -> list[tuple[np.ndarray, pa.Array]]:
    """The items in blocks of bounded rows and bytes, one block at a time on the driver."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(1, ceil(size.n / BLOCK_ITEMS), ceil((size.b or 0) / BLOCK_BYTES))
    for i in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("doc", "tag"), F.lit(blocks)) == i) if blocks > 1 else rows
        table = mine.select("doc", "text").toArrow()
        yield table["doc"].to_numpy(), table["text"].combine_chunks()


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc, tag, item, n_shared, n_item) of every item that a document holds."""
    rows, out = keyed(docs, id_col, text_col), None
    for ids, texts in _item_blocks(keyed(benchmark, item_col, item_text_col)):
        shared = docs.sparkSession.sparkContext.broadcast((ids, texts))
        part = rows.mapInArrow(_search(shared, shingle, percent), "doc long, tag long, item long, n_shared long, n_item long")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def uncontaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of `docs` that hold no item, dropped where they are read."""
    rows = docs.select(whole_row(docs).alias("row"), F.col(text_col).alias("text"))
    for ids, texts in _item_blocks(keyed(benchmark, item_col, item_text_col)):
        shared = docs.sparkSession.sparkContext.broadcast((ids, texts))
        rows = rows.mapInArrow(_clean(shared, shingle, percent), rows.schema)
    return rows.select("row.*")


def _clean(shared, shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value, shingle, percent)
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            clean = np.ones(batch.num_rows, bool)
            for a, b in slices(offsets):
                row, _, _ = held_items(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], items, shingle, percent)
                clean[a + row] = False
            yield batch.filter(pa.array(clean))

    return run


def query(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, items).select(given_id().alias("doc_id"), given_id("item").alias("item_id"), "n_shared", "n_item")


_SETS = r"""SELECT {id} AS id, sh FROM (
  SELECT {id}, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) ELSE [array_to_string(ws, ' ')] END) AS sh FROM (
    SELECT {id}, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM {table}) WHERE len(ws) > 0)
  GROUP BY ALL"""
SQL = f"""WITH d AS ({_SETS.format(id='doc_id', table='documents')}), b AS ({_SETS.format(id='item_id', table='benchmark')}),
n AS (SELECT id, count(*) AS n FROM b GROUP BY 1)
SELECT d.id AS doc_id, b.id AS item_id, count(*)::BIGINT AS n_shared, any_value(n.n)::BIGINT AS n_item
FROM d JOIN b USING (sh) JOIN n ON n.id = b.id GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * any_value(n.n)"""
