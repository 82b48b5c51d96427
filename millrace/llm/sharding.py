"""Shards of near equal size: minimax partition of an ordered list of atomic groups.

Rows with equal texts are a group that no cut may split. Groups are ordered by the SHA-256 of
their text, and a shard is a stretch of that order, so the plan is a few digests and a row's shard
is a comparison with them. The law is `bytes`: the cuts are those of the smallest capacity at which
the groups, packed greedily in order, fit into the wished number of shards.

1. Rows are sorted by (digest, doc_id, place in the input) into range partitions, which a group of any
   number of copies spans, and written with running sums of bytes and rows within the partition. One
   sum a partition then makes them running sums of the table.
2. The end of each group in running bytes is a place where one may cut. The capacity is found by binary search with
   a greedy check. The check does not need all ends: they are first counted in `CELLS` even cells, of which the
   driver holds the first and the last end. Packing with only the known ends gives a capacity that is large enough, and
   packing as if a cell could be cut anywhere one that is too small by at most a cell. The search goes on in
   the stretches where a cut can still fall, in finer cells, until both meet. So the result is exact, and the driver
   holds `CELLS` pairs of numbers at every size of the table.
3. Shard and slot of a row follow from its running sums and the cuts, without a join.

`write_shards` writes the whole rows: the shard is computed from the digest where a row is read, one range
exchange brings rows into the order of their slots.

Defined results: null and empty texts are one group, with a size of 1. Rows without doc_id come last in
their group. Repeated rows have slots of their own. With fewer groups than shards some of the later shards are empty. An
empty table gives no rows, and its plan has no cuts. Texts of any length count whole. Other columns are not
looked at, whatever they are called; `write_shards` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import NO_ID, given_id, partitions, whole_row
from millrace.session import written

SHARDS, MOST_SHARDS, CELLS = 8, 256, 1 << 14


@dataclass
class Plan:
    """Capacity, and of every shard but the last used one its last digest; bytes and rows up to each cut."""

    shards: int
    capacity: int
    digests: list[str]
    bytes_to: list[int]
    rows_to: list[int]

    def shard(self, digest: Column) -> Column:
        """The shard of a row with this digest."""
        return sum(((digest > F.lit(d)).cast("int") for d in self.digests), F.lit(0))


def text_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


# ---------------------------------------------------------------- running sums


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition's number and its running sums of bytes and rows."""
    chunk, size_to, row_to = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(batch["size"].to_numpy()) + size_to
        row = np.arange(1, batch.num_rows + 1) + row_to
        size_to, row_to = int(size[-1]), int(row[-1])
        yield pa.RecordBatch.from_arrays(
            [batch["digest"], batch["doc"], batch["size"], batch["crc"], pa.array(np.full(batch.num_rows, chunk), pa.int32()), pa.array(size), pa.array(row)],
            ["digest", "doc", "size", "crc", "chunk", "bytes_to", "rows_to"])


_RUNNING = "digest string, doc long, size long, crc long, chunk int, bytes_to long, rows_to long"


def running_sums(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, doc, size, crc, bytes_to, rows_to) of every row, sums taken in the order of (digest, doc)."""
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        text_digest(F.col(text_col)).alias("digest"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"), F.monotonically_increasing_id().alias("place"))
    rows = written(rows, "sizes")  # texts are read once; the sort samples this table
    order = ["digest", "doc", "place"]
    sums = written(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_running, _RUNNING), "running")
    totals = sorted(sums.groupBy("chunk").agg(F.max("bytes_to").alias("b"), F.max("rows_to").alias("r")).collect())  # one row a partition
    before, b, r = [], 0, 0
    for t in totals:
        before.append((t.chunk, b, r))
        b, r = b + t.b, r + t.r
    offsets = F.broadcast(spark.createDataFrame(before, "chunk int, b long, r long"))
    return sums.join(offsets, "chunk").select("digest", "doc", "size", "crc", (F.col("bytes_to") + F.col("b")).alias("bytes_to"), (F.col("rows_to") + F.col("r")).alias("rows_to"))


# ---------------------------------------------------------------- the capacity


class Ends:
    """What is known of the ends of groups: stretches (first, last, number of ends) in order; the
    first and last end of a stretch are known, the ends between them are not."""

    def __init__(self, first: np.ndarray, last: np.ndarray, count: np.ndarray):
        self.first, self.last, self.count = first, last, count
        self.known = np.unique(np.concatenate([first, last]))

    def reach(self, capacity: int, shards: int, anywhere: bool) -> list[int]:
        """Where the greedy packing cuts; `anywhere`: as if stretches of three ends or more could be cut at any byte."""
        cuts, at = [], 0
        for _ in range(shards):
            to = at + capacity
            k = int(np.searchsorted(self.known, to, "right")) - 1
            best = int(self.known[k]) if k >= 0 else at
            if anywhere:
                i = int(np.searchsorted(self.first, to, "right")) - 1
                if i >= 0 and self.count[i] > 2 and to < self.last[i]:
                    best = to
            at = max(at, best)
            cuts.append(at)
        return cuts

    def capacity(self, shards: int, anywhere: bool) -> int:
        """The smallest capacity at which the packing comes to the end."""
        total = int(self.known[-1])
        low, high = -(-total // shards), total
        while low < high:
            middle = (low + high) // 2
            if self.reach(middle, shards, anywhere)[-1] == total:
                high = middle
            else:
                low = middle + 1
        return low


def _cells(ends: DataFrame, windows: list[tuple[int, int]], cells: int) -> Ends:
    """The ends within the windows (from, to], in even cells: first, last and number of ends of each."""
    per = max(1, cells // len(windows))
    choices = []
    for i, (a, b) in enumerate(windows):
        width = max(1, -(-(b - a) // per))
        choices.append(F.when((F.col("end") > a) & (F.col("end") <= b), F.floor((F.col("end") - a - 1) / width) + i * per))
    found = ends.select("end", F.coalesce(*choices).cast("long").alias("cell")).where("cell IS NOT NULL").groupBy("cell").agg(F.min("end").alias("a"), F.max("end").alias("b"), F.count(F.lit(1)).alias("n"))
    got = sorted((r.a, r.b, r.n) for r in found.collect())  # at most `cells` rows
    return Ends(*np.array(got, np.int64).reshape(-1, 3).T)


def smallest_capacity(ends: DataFrame, total: int, shards: int, least_cells: int = CELLS) -> tuple[int, list[int]]:
    """The capacity and the cuts for groups that end at `end` (running bytes, all different)."""
    # The cut after shard i can lie in i + 1 cells or so; with this many, the cells get finer in every round.
    cells = max(least_cells, 16 * shards * shards)
    known = _cells(ends, [(0, total)], cells)
    while True:
        low, high = known.capacity(shards, True), known.capacity(shards, False)
        least, most = known.reach(low, shards, False), known.reach(high, shards, True)
        touched = np.zeros(len(known.first), bool)
        for a, b in zip(least, most, strict=True):
            touched |= (known.first < b) & (known.last > a)
        hit = np.flatnonzero(touched & (known.count > 2))
        if not len(hit):
            return high, known.reach(high, shards, False)
        # One window for each cut, from the first to the last stretch that it can fall into; overlapping ones are joined.
        spans = [(i[0], i[-1]) for a, b in zip(least, most, strict=True) if len(i := hit[(known.first[hit] < b) & (known.last[hit] > a)])]
        joined = [spans[0]]
        for i, j in spans[1:]:
            if i <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(j, joined[-1][1]))
            else:
                joined.append((i, j))
        finer = _cells(ends, [(int(known.first[i]) - 1, int(known.last[j])) for i, j in joined], cells)
        keep = np.ones(len(known.first), bool)
        for i, j in joined:
            keep[i : j + 1] = False
        parts = [np.concatenate([getattr(known, c)[keep], getattr(finer, c)]) for c in ("first", "last", "count")]
        order = np.argsort(parts[0])
        known = Ends(*(p[order] for p in parts))


# ---------------------------------------------------------------- shards


def plan(sums: DataFrame, shards: int = SHARDS) -> Plan:
    """The cuts for the rows of `running_sums`."""
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"between 1 and {MOST_SHARDS} shards")
    groups = written(sums.groupBy("digest").agg(F.max("bytes_to").alias("end"), F.max("rows_to").alias("rows")), "groups")
    total = groups.agg(F.max("end")).first()[0]
    if total is None:
        return Plan(shards, 0, [], [], [])
    capacity, cuts = smallest_capacity(groups.select("end"), total, shards)
    inner = sorted({c for c in cuts if c < total})
    at = sorted(groups.where(F.col("end").isin(inner)).collect(), key=lambda r: r.end) if inner else []
    return Plan(shards, capacity, [r.digest for r in at], [r.end for r in at], [r.rows for r in at])


def assigned(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    sums = running_sums(docs, id_col, text_col)
    cuts = plan(sums, shards)
    shard = sum(((F.col("bytes_to") > b).cast("int") for b in cuts.bytes_to), F.lit(0))
    before = F.lit(0).cast("long")
    for b, r in zip(cuts.bytes_to, cuts.rows_to, strict=True):
        before = F.when(F.col("bytes_to") > b, F.lit(r).cast("long")).otherwise(before)
    return sums.select(given_id().alias("doc_id"), "size", F.col("crc").alias("text_crc32"), shard.cast("int").alias("shard"), (F.col("rows_to") - 1 - before).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> Plan:
    """Writes the rows of `docs` as Parquet below `path`, one folder `part_of=<shard>` a shard, in the order of the slots."""
    cuts, n = plan(running_sums(docs, id_col, text_col), shards), partitions(docs.sparkSession)
    digest, doc = text_digest(F.col(text_col)), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    rows = docs.select(digest.alias("digest"), doc.alias("doc"), F.monotonically_increasing_id().alias("place"), whole_row(docs).alias("row"))
    order = ["digest", "doc", "place"]
    sorted_rows = rows.withColumn("part_of", cuts.shard(F.col("digest"))).repartitionByRange(n, *order).sortWithinPartitions("part_of", *order)
    sorted_rows.select("part_of", "row").write.partitionBy("part_of").parquet(path)
    return cuts


def query(spark, sf_dir: str) -> DataFrame:
    out = assigned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# Bytes, digests and the packing in SQL; crc32 byte by byte with the table of the reflected polynomial.
SQL = """WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)) AS t),
d AS (SELECT doc_id, sha256(coalesce(text, '')) AS g, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes FROM documents),
c AS (SELECT doc_id, g, size, xor(list_reduce(bytes, lambda c, x: xor(t[1 + (xor(c, ('0x' || x)::BIGINT) & 255)], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT) AS crc
  FROM (SELECT doc_id, g, size, list_transform(bytes, lambda x: x) AS bytes, t FROM d, t)),
e AS (SELECT g, sum(sum(size)) OVER (ORDER BY g)::BIGINT AS e FROM c GROUP BY g),
l AS (SELECT list(e ORDER BY e) AS es, max(e) AS total FROM e),
s(low, high) AS (
  SELECT 1::BIGINT, total FROM l UNION ALL
  SELECT CASE WHEN ok THEN low ELSE mid + 1 END, CASE WHEN ok THEN mid ELSE high END FROM (
    SELECT low, high, mid, list_reduce(range(8), lambda p, k: greatest(p, coalesce(list_max(list_filter(es, lambda x: x <= p + mid)), 0)), 0::BIGINT) = total AS ok
    FROM (SELECT low, high, (low + high) // 2 AS mid, es, total FROM s, l WHERE low < high))),
cap AS (SELECT low AS c FROM s WHERE low = high LIMIT 1),
cuts AS (SELECT DISTINCT k, list_reduce(range(k), lambda p, i: greatest(p, coalesce(list_max(list_filter(es, lambda x: x <= p + c)), 0)), 0::BIGINT) AS cut FROM range(1, 8) r(k), l, cap),
p AS (SELECT c.*, (SELECT count(DISTINCT cut) FROM cuts WHERE cut < e.e) AS shard FROM c JOIN e USING (g))
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard, row_number() OVER (PARTITION BY shard ORDER BY g, doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard FROM p"""
