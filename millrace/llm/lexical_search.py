"""Ranked lexical search by dense blocked matrix products: items x terms times terms x documents.

A term weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))) and has in a document the impact
w * ((10^9 tf) div (1000 tf + 8 m)), with m = 25 + (75 n N) div L. A document's score for an item is the
sum of the impacts of the item's terms, repeats included. All impacts are whole numbers; the products run in float64,
where they are exact because no partial sum of a tile reaches 2^53; tiles are added in 64-bit integers.

1. Items are a query set. They are taken in blocks of bounded bytes; the vocabulary is that of the block.
2. Documents are read once a block: each becomes (doc, n, places in the vocabulary, tf), written to the shared folder.
   N, L and df are aggregates of that table (df: one number a vocabulary term).
3. Documents are taken in tiles. A tile has a dense impact matrix over the vocabulary terms that occur in it, in stretches of
   at most `TERMS` terms, each of so many that `max repeats x w x 10^6`, summed over the stretch, stays below 2^53 (a term with
   more repeats is dealt over several columns). The items' repeats are a dense matrix over the same terms; BLAS multiplies both.
4. From the scores of a tile every item keeps its `k` best: all scores not below the k-th largest are ordered by (score, doc_id), so that
   ties at the border are decided by doc_id and never by place. They are merged with the best of the partition so far; the
   best of all partitions meet in two rounds, by item and salt and then by item.

Defined results: a null, empty or blank text has no term and is in no count; an item without terms has no rows.
Documents that repeat a doc_id are ranked one by one. A row without doc_id comes after all others of its score.
Items that repeat an item_id are ranked one by one and share the name. Texts of any length count whole; empty tables give no rows; other
columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, Words, given_id, keyed, ranges_to_bytes, runs, share, slices, text_buffers
from millrace.session import written

BEST = 10
BLOCK_ITEMS, BLOCK_BYTES = 1024, 4 << 20
DOCUMENTS, TERMS, EXACT = 512, 2048, 1 << 53
SCALE = 10**9
MERGES = 64

# Bytes in no term: all of ASCII but digits and letters.
BREAK = np.zeros(256, bool)
BREAK[:128] = True
BREAK[np.r_[48:58, 65:91, 97:123]] = False


# ---------------------------------------------------------------- items and documents as terms


class Items:
    """The items of a block: names, and their terms as (item, place in the vocabulary, repeats)."""

    def __init__(self, ids: np.ndarray, texts: pa.Array):
        words = Words(*text_buffers(texts), BREAK)
        self.ids = ids
        self.vocabulary, place = np.unique(words.hashes(LOWER), return_inverse=True)
        pair, self.repeats = np.unique(words.row * max(len(self.vocabulary), 1) + place, return_counts=True)
        self.item, self.term = pair // max(len(self.vocabulary), 1), pair % max(len(self.vocabulary), 1)
        self.most = np.zeros(len(self.vocabulary), np.int64)  # most repeats of a term in one item
        np.maximum.at(self.most, self.term, self.repeats)


def _lists(values: np.ndarray, size: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(values.astype(kind)))


_COUNTS = "doc long, n long, terms array<int>, tfs array<int>"


def _term_counts(items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = items().vocabulary
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            doc = batch["doc"].to_numpy()
            for a, b in slices(offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], BREAK)
                value = words.hashes(LOWER)
                place = np.searchsorted(vocabulary, value)
                hit = np.flatnonzero(vocabulary.take(place, mode="clip") == value) if len(vocabulary) else place[:0]
                pair, tf = np.unique(words.row[hit] * max(len(vocabulary), 1) + place[hit], return_counts=True)
                row, term = pair // max(len(vocabulary), 1), pair % max(len(vocabulary), 1)
                size = np.bincount(row, minlength=b - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[a:b]), pa.array(words.count.astype(np.int64)), _lists(term, size, np.int32), _lists(tf, size, np.int32)], ["doc", "n", "terms", "tfs"])

    return run


# ---------------------------------------------------------------- scores


@dataclass
class Weights:
    """Documents with a term, their terms, and the weight of each vocabulary term."""

    documents: int
    length: int
    term: np.ndarray

    @classmethod
    def of(cls, documents: int, length: int, df: np.ndarray) -> Weights:
        return cls(documents, length, np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64))

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Impact of a term with this tf in a document of n terms."""
        if 75 * int(n.max(initial=0)) * self.documents < 2**63:
            m = 25 + 75 * n * self.documents // self.length
        else:
            m = np.array([25 + 75 * x * self.documents // self.length for x in n.tolist()], np.int64)
        return self.term[term] * (SCALE * tf // (1000 * tf + 8 * m))


def columns(most: np.ndarray, weight: np.ndarray, terms: int = TERMS, exact: int = EXACT) -> list[tuple[np.ndarray, np.ndarray]]:
    """Stretches of (term, its largest number of repeats in a column) whose sums stay exact; a term of too many repeats for
    one column comes several times."""
    bound = weight * (SCALE // 1000)  # above every impact of the term
    out, own, sum_ = [], [], 0
    for t, (q, b) in enumerate(zip(most.tolist(), bound.tolist(), strict=True)):
        while q > 0:
            take = min(q, max(1, (exact - 1) // max(b, 1)))
            if own and (len(own) == terms or sum_ + take * b >= exact or own[-1][0] == t):
                out.append(own)
                own, sum_ = [], 0
            own.append((t, take))
            sum_ += take * b
            q -= take
    out += [own] if own else []
    return [(np.array([t for t, _ in c]), np.array([q for _, q in c])) for c in out]


class Search:
    """Scores of document tiles for all items of a block."""

    def __init__(self, items: Items, weights: Weights, k: int):
        self.items, self.weights, self.k = items, weights, k
        self.stretches = columns(items.most, weights.term)
        order = np.argsort(items.term, kind="stable")
        self.item, self.term, self.repeats = items.item[order], items.term[order], items.repeats[order]
        self.at = np.searchsorted(self.term, np.arange(len(items.vocabulary) + 1))

    def scores(self, n: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Items x documents; (row, term, tf) are the vocabulary terms of the documents, n their lengths."""
        total = np.zeros((len(self.items.ids), len(n)), np.int64)
        impact = self.weights.impacts(term, tf, n[row])
        used = np.zeros(len(self.items.vocabulary), bool)
        used[term[impact > 0]] = True
        done = np.zeros(len(self.items.vocabulary), np.int64)  # repeats of a term that earlier stretches have taken
        place = np.full(len(self.items.vocabulary), -1)
        for terms, take in self.stretches:
            mine = terms[used[terms]]
            if len(mine):
                place[mine] = np.arange(len(mine))
                documents = np.zeros((len(mine), len(n)))
                inside = place[term] >= 0
                documents[place[term[inside]], row[inside]] = impact[inside]
                first, size = self.at[mine], self.at[mine + 1] - self.at[mine]
                entry = ranges_to_bytes(first, size)
                most = np.zeros(len(used), np.int64)
                most[terms] = take
                repeats = np.clip(self.repeats[entry] - done[self.term[entry]], 0, most[self.term[entry]])
                wanted = np.zeros((len(self.items.ids), len(mine)))
                wanted[self.item[entry], place[self.term[entry]]] = repeats
                total += (wanted @ documents).astype(np.int64)
                place[mine] = -1
            done[terms] += take
        return total

    def best_of_tile(self, doc: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, doc, score) of the k best documents of each item, ties by doc."""
        if score.shape[1] > self.k:
            border = np.partition(score, score.shape[1] - self.k, axis=1)[:, score.shape[1] - self.k]
            item, at = np.nonzero((score >= border[:, None]) & (score > 0))
        else:
            item, at = np.nonzero(score > 0)
        return self.ranked(item, doc[at], score[item, at])

    def ranked(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        first, size = runs(np.append(True, item[1:] != item[:-1])) if len(item) else (order, order)
        rank = np.arange(len(item)) - np.repeat(first, size)
        stays = rank < self.k
        return item[stays], doc[stays], score[stays]


_FOUND = "block int, item int, item_id long, doc long, score long"


def _best(items, weights: Weights, block: int, k: int):
    """The best documents of the partition for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, best = Search(items(), weights, k), None
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch["terms"]), 0))
            for a in range(0, batch.num_rows, DOCUMENTS):
                tile = batch.slice(a, DOCUMENTS)
                size = pc.list_value_length(tile["terms"]).to_numpy()
                term, tf = (tile[c].flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs"))
                doc = tile["doc"].to_numpy()
                found = search.best_of_tile(doc, search.scores(tile["n"].to_numpy(), np.repeat(np.arange(len(doc)), size), term, tf))
                best = found if best is None else search.ranked(*(np.concatenate(x) for x in zip(best, found, strict=True)))
        if best is not None and len(best[0]):
            item, doc, score = best
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(item), block), pa.int32()), pa.array(item, pa.int32()), pa.array(search.items.ids[item]), pa.array(doc), pa.array(score)],
                ["block", "item", "item_id", "doc", "score"])

    return run


# ---------------------------------------------------------------- the operator


def _item_blocks(rows: DataFrame) -> Iterator[Items]:
    """The items in blocks of bounded rows and bytes, one block at a time on the driver."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(1, math.ceil(size.n / BLOCK_ITEMS), math.ceil((size.b or 0) / BLOCK_BYTES))
    for i in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("doc", "tag"), F.lit(blocks)) == i) if blocks > 1 else rows
        table = mine.select("doc", "text").toArrow()
        if table.num_rows:
            yield Items(table["doc"].to_numpy(), table["text"].combine_chunks())


def search(docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k documents of highest score above 0."""
    spark, rows = docs.sparkSession, keyed(docs, id_col, text_col).select("doc", "text")
    found = spark.createDataFrame([], _FOUND)
    for number, block in enumerate(_item_blocks(keyed(items, item_col, item_text_col))):
        shared = share(spark, block)
        counts = written(rows.mapInArrow(_term_counts(shared), _COUNTS), "terms")
        total = counts.where("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
        df = np.zeros(len(block.vocabulary), np.int64)
        for r in counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():
            df[r.term] = r.df
        weights = Weights.of(total.documents, total.length or 0, df)
        found = found.unionByName(counts.mapInArrow(_best(shared, weights, number, k), _FOUND))
    best = [F.desc("score"), F.asc("doc")]
    salted = Window.partitionBy("block", "item", F.pmod(F.xxhash64("doc"), F.lit(MERGES))).orderBy(*best)
    found = found.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("block", "item").orderBy(*best))).where(F.col("rank") <= k)
    return found.select(given_id("item_id").alias("item_id"), "rank", given_id("doc").alias("doc_id"), "score")


def query(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs, items)


_TERMS = r"""SELECT {id} AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM {table}"""
SQL = f"""WITH d AS (SELECT id, term, count(*)::BIGINT AS tf FROM ({_TERMS.format(id='doc_id', table='documents')}) GROUP BY 1, 2),
q AS (SELECT id, term, count(*)::BIGINT AS q FROM ({_TERMS.format(id='item_id', table='benchmark')}) GROUP BY 1, 2),
n AS (SELECT id, sum(tf)::BIGINT AS n FROM d GROUP BY 1), s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS len FROM n),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM d, s WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
p AS (SELECT q.id AS item_id, d.id AS doc_id, sum(q.q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // len))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN d USING (term) JOIN n ON n.id = d.id, s GROUP BY 1, 2)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM p WHERE score > 0) WHERE rank <= 10"""
