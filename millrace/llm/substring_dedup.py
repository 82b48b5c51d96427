"""Removal of word passages that occur before, over all documents.

Every window of `window` consecutive words gets a Rabin-Karp hash. Windows are dealt
to buckets by their least 8-word hash, which equal windows share; neighbouring windows
mostly share it too, so they travel as runs with one position (about seven windows a
run). A slice of documents sends each different window once, so that a passage that a
third of all documents hold reaches its bucket once per slice. The bucket compares
the hashes, finds the first place of each (least document, then least start) and
returns the others as runs. Overlapping runs merge into maximal removal intervals
where the words are cut.

Two different windows are taken for equal only if they agree in 64 bits and in their
bucket; over 10^10 windows the expected number of such pairs is below one.

Defined results: a null text has no words; a text shorter than a window keeps all of
them. Rows that repeat a doc_id are separate documents with equal rank: none is earlier
than the other at the same start. A null doc_id comes after all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    Words, given_id, keyed, ngram_hashes, partitions, ranges_to_bytes, runs, slices, sliding_min, text_buffers, whole_windows,
)

ANCHOR = 8
BUCKETS_PER_PARTITION = 8
_META = np.dtype([("doc", "<i8"), ("tag", "<i8"), ("at", "<u4"), ("n", "<u4")])


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed and `kept`, the words that stay, joined by one blank."""
    spark = docs.sparkSession
    rows, n = keyed(docs, id_col, text_col), partitions(docs.sparkSession)
    sent = rows.mapInArrow(_windows(window, n * BUCKETS_PER_PARTITION), "bucket int, kind int, n int, meta binary, hashes binary")
    found = sent.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_later_runs, "doc long, tag long, run long")
    cuts = found.groupBy("doc", "tag").agg(F.collect_list("run").alias("runs"))
    joined = rows.join(cuts.hint("shuffle_hash"), ["doc", "tag"], "left").select("doc", "text", "runs")
    kept = joined.mapInArrow(_cut(window), "doc long, n_words long, n_removed long, kept string")
    return kept.select(given_id().alias("doc_id"), "n_words", "n_removed", "kept")


def _pack(kind: int, bucket: int, meta: np.ndarray, hashes: np.ndarray) -> tuple:
    columns = b"".join(np.ascontiguousarray(meta[c]).tobytes() for c in _META.names)
    return bucket, kind, len(meta), pa.compress(columns, codec="zstd", asbytes=True), hashes.tobytes()


def _unpack(n: int, data: bytes) -> np.ndarray:
    raw, out, at = pa.decompress(data, n * _META.itemsize, codec="zstd", asbytes=True), np.empty(n, _META), 0
    for c in _META.names:
        size = _META[c].itemsize * n
        out[c] = np.frombuffer(raw, _META[c], n, at)
        at += size
    return out


def _windows(window: int, buckets: int):
    anchor = min(ANCHOR, window)

    def slice_rows(words: Words, doc: np.ndarray, tag: np.ndarray) -> list[tuple]:
        hashes = words.hashes()
        at = np.flatnonzero(whole_windows(words.row, window))
        if not len(at):
            return []
        value = ngram_hashes(hashes, window)[at]
        least = sliding_min(ngram_hashes(hashes, anchor), window - anchor + 1)[at]
        row, start = words.row[at], at - words.bounds[words.row[at]]
        # Which windows have an earlier one in this slice: rows come in order of doc.
        place = (np.cumsum(np.append(0, doc[1:] != doc[:-1]))[row] << 32) + start
        order = np.argsort(value)
        first, size = runs(np.append(True, value[order][1:] != value[order][:-1]))
        earliest = np.empty(len(at), np.int64)
        earliest[order] = np.repeat(np.minimum.reduceat(place[order], first), size)
        late = place > earliest
        out = []
        joined = np.append(False, (row[1:] == row[:-1]) & (start[1:] == start[:-1] + 1) & (least[1:] == least[:-1]))
        for kind, mine in ((0, ~late), (1, late)):
            if not mine.any():
                continue
            r, s, h, v = row[mine], start[mine], least[mine], value[mine]
            begin = ~joined[mine]
            begin[1:] |= np.diff(np.flatnonzero(mine)) != 1
            begin[0] = True
            first, size = runs(begin)
            meta = np.empty(len(first), _META)
            meta["doc"], meta["tag"], meta["at"], meta["n"] = doc[r[first]], tag[r[first]], s[first], size
            bucket = (h[first] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            for f, n in zip(*runs(np.append(True, np.diff(bucket[order]) != 0)), strict=True):
                pick = order[f : f + n]
                own = v[ranges_to_bytes(first[pick], size[pick])] if kind == 0 else v[:0]
                out.append(_pack(kind, int(bucket[pick[0]]), meta[pick], own))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.sort_by("doc")
            doc, tag = batch["doc"].to_numpy(), batch["tag"].to_numpy()
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets):
                out = slice_rows(Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), doc[a:b], tag[a:b])
                if out:
                    cols = list(zip(*out, strict=True))
                    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["bucket", "kind", "n", "meta", "hashes"])

    return run


def _run_rows(doc: np.ndarray, tag: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    packed = (at.astype(np.int64) << 31) | n.astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tag), pa.array(packed)], ["doc", "tag", "run"])


def _later_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of a bucket that are not the first of their words, as runs."""
    held, bucket = [], None
    for batch in batches:
        for b, kind, n, meta, hashes in zip(*(batch[c].to_pylist() for c in ("bucket", "kind", "n", "meta", "hashes")), strict=True):
            if b != bucket:
                yield from _decided(held)
                held, bucket = [], b
            meta = _unpack(n, meta)
            if kind == 1:
                yield _run_rows(meta["doc"], meta["tag"], meta["at"], meta["n"])
            else:
                held.append((meta, np.frombuffer(hashes, np.uint64)))
    yield from _decided(held)


def _decided(held: list) -> Iterator[pa.RecordBatch]:
    if len(held) < 2:  # a slice has sent its windows once
        return
    meta, value = np.concatenate([m for m, _ in held]), np.concatenate([h for _, h in held])
    order = np.argsort(value)
    first, size = runs(np.append(True, value[order][1:] != value[order][:-1]))
    again = order[np.repeat(size > 1, size)]
    if not len(again):
        return
    owner = np.repeat(np.arange(len(meta)), meta["n"])
    start = meta["at"].astype(np.int64)[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(meta["n"]) - meta["n"], meta["n"])
    doc = meta["doc"][owner]
    again = again[np.lexsort((start[again], doc[again], value[again]))]
    v = value[again]
    first, size = runs(np.append(True, v[1:] != v[:-1]))
    head = np.repeat(again[first], size)
    late = np.sort(again[(doc[again] != doc[head]) | (start[again] != start[head])])
    if len(late):
        begin = np.append(True, (np.diff(late) != 1) | (owner[late][1:] != owner[late][:-1]))
        first, size = runs(begin)
        yield _run_rows(doc[late[first]], meta["tag"][owner[late[first]]], start[late[first]], size)


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, packed in zip(batch["text"], batch["runs"], strict=True):
                words = text.as_py().encode().split()
                total.append(len(words))
                if packed.is_valid and len(packed):
                    run_at = packed.values.to_numpy(zero_copy_only=False)
                    at, n = run_at >> 31, run_at & (2**31 - 1)
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, at, 1)
                    np.add.at(depth, at + n + window - 1, -1)
                    stays = np.cumsum(depth[:-1]) == 0
                    words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc", "n_words", "n_removed", "kept"])

    return run


def query(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 19), ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM g) WHERE k > 1),
cut AS (SELECT DISTINCT doc_id, i + d AS i FROM late, range(20) t(d)),
kept AS (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS s, count(*) AS n FROM p ANTI JOIN cut USING (doc_id, i) GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.s, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""
