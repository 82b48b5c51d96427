"""Near-duplicate documents by Fast Similarity Sketching, banding and exact checks.

1. A document is its set of distinct shingles. Documents of equal sets form a class
   (one grouping, so thousands of copies meet as one row per task).
2. The sketch of a set fills its coordinates in rounds: in round i every shingle is
   thrown into one bin by hash i, from round t on all of them into bin i - t. A bin
   keeps its earliest and least hash. A set stops when all bins are full, so round 0
   nearly does it for long texts, and 2 t rounds always do.
3. Bands of `ROWS` coordinates are keys. Classes that share a key are sorted into
   range partitions (a hot key spans several) and linked to the first; the links' components are
   the families: two sets that are similar enough share a family except with probability
   (1 - J^4)^32, below 1e-7 at J = 0.8 and 1e-10 at J = 0.85.
4. Links are confirmed on the full sets. A family of bounded size is compared within
   one task. A larger one is first compared with 32 of its members, in blocks; then the
   members that this leaves outside the family's main component are compared with
   all members, in blocks. No pair is lost: any link either lies within the main
   component or has such a member at one end.

Defined results: null, empty and blank texts have no shingles and are linked with
nothing; a text of fewer words than a shingle is one shingle. Rows that repeat a doc_id
share a component. A row without doc_id cannot be named in a component: it is kept, linked with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, NO_ID, Words, given_id, grouped, keyed, mix, partitions, runs, shingle_rows, slices, text_buffers, whole_row
from millrace.llm.components import components
from millrace.session import written

COORDINATES, ROWS = 128, 4
FAMILY_MEMBERS, FAMILY_SHINGLES = 512, 4_000_000
CENTRES, BLOCK = 32, 256
_FREE = np.uint64(2**64 - 1)
_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def fast_sketch(value: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Sketches of n sets given as distinct (value, row) items; rows without items stay free."""
    t = COORDINATES
    out = np.full(n * t, _FREE)
    for i in range(2 * t):
        if not len(value):
            break
        h = mix(value ^ _SEEDS[i])
        place = (h & np.uint64(t - 1)).astype(np.int64) if i < t else i - t
        np.minimum.at(out, row * t + place, (np.uint64(i) << np.uint64(55)) | (h >> np.uint64(9)))
        more = (out.reshape(n, t) == _FREE).any(axis=1)[row]
        value, row = value[more], row[more]
    return out.reshape(n, t)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    bands = sketch.reshape(len(sketch), -1, ROWS)
    key = np.zeros(bands.shape[:2], np.uint64) + np.arange(bands.shape[1], dtype=np.uint64)
    for i in range(ROWS):
        key = mix(key * np.uint64(0xD1342543DE82EF95) + bands[:, :, i])
    return key


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, and the number per row."""
    words = Words(data, offsets)
    value, row = shingle_rows(words, words.hashes(LOWER), shingle)
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    sets = [np.unique(value[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return np.concatenate([value[:0], *sets]), np.array([len(s) for s in sets], np.int64)


def _sketches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets):
                value, size = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shingle)
                row = np.repeat(np.arange(b - a), size)
                total = [np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)]
                for k, seed in enumerate((1, 2)):
                    np.add.at(total[k], row, mix(value ^ _SEEDS[seed]) * np.uint64(seed))
                keys = band_keys(fast_sketch(value, row, b - a))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc"].slice(a, b - a), batch["tag"].slice(a, b - a), pa.array(size), *[pa.array(t.view(np.int64)) for t in total], bands],
                    ["doc", "tag", "n", "s1", "s2", "bands"])

    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links every row to the first one of its key, in rows sorted by (key, doc). The partition's
    first and last key come back as (key, a, null), because they may go on in another one."""
    kinds = pa.schema([(c, pa.int64()) for c in ("key", "a", "b")])

    def rows(key, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (key, a, b)], schema=kinds)

    head = None  # key and first document of the run that reaches into the next batch
    for batch in batches:
        key, doc = batch["key"].to_numpy(), batch["doc"].to_numpy()
        if not len(key):
            continue
        if head is None:
            yield rows([key[0]], [doc[0]], [None])
        first, size = runs(np.append(True, key[1:] != key[:-1]))
        root = doc[first].copy()
        if head is not None and head[0] == key[0]:
            root[0] = head[1]
        to = np.repeat(root, size)
        apart = np.flatnonzero(to != doc)
        yield rows([None] * len(apart), to[apart], doc[apart])
        head = key[-1], root[-1]
    if head is not None:
        yield rows([head[0]], [head[1]], [None])


def families(classes: DataFrame) -> DataFrame:
    """(node, component) of the classes that share a band key with another one."""
    n = partitions(classes.sparkSession)
    keys = classes.select("doc", F.explode("bands").alias("key"))
    out = written(keys.repartitionByRange(n, "key", "doc").sortWithinPartitions("key", "doc").mapInArrow(_linked, "key long, a long, b long"), "links")
    ends = out.where("b IS NULL").select("key", "a")
    across = ends.join(ends.groupBy("key").agg(F.min("a").alias("b")), "key").select("a", "b")
    return components(out.where("b IS NOT NULL").select("a", "b").unionByName(across))


class _Sets:
    """Shingle sets side by side: how much one of them shares with all others."""

    def __init__(self, texts: pa.Array, shingle: int):
        data, offsets = text_buffers(texts)
        self.value, self.size = shingle_sets(data, offsets, shingle)
        _, self.code = np.unique(self.value, return_inverse=True)
        self.at = np.append(0, np.cumsum(self.size))
        self.mark = np.zeros(len(self.value) + 1, np.int64)

    def linked(self, i: int, first: int, last: int, percent: int) -> np.ndarray:
        """The sets of [first, last) that are linked with set i."""
        own = self.code[self.at[i] : self.at[i + 1]]
        self.mark[own] = 1
        shared = np.add.reduceat(self.mark[self.code[self.at[first] : self.at[last]]], self.at[first:last] - self.at[first])
        self.mark[own] = 0
        return first + np.flatnonzero(100 * shared >= percent * (self.size[i] + self.size[first:last] - shared))


def _pairs(a: list, b: list) -> pa.RecordBatch | None:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]) if len(a) else None


def _whole_family(percent: int, shingle: int):
    def run(group: pa.Table) -> pa.RecordBatch | None:
        doc, sets = group["doc"].to_numpy(), _Sets(group["text"], shingle)
        label = np.arange(len(doc))
        for i in range(len(doc) - 1):
            for other in np.unique(label[sets.linked(i, i + 1, len(doc), percent)]):
                if other != label[i]:
                    label[label == other] = label[i]
        least = np.full(len(doc), NO_ID)
        np.minimum.at(least, label, doc)
        return _pairs(doc, least[label])

    return run


def _block_links(percent: int, shingle: int):
    """Links between the queries (role 0) and the members (role 1) of a block, one for
    each query and label."""

    def run(group: pa.Table) -> pa.RecordBatch | None:
        group = group.sort_by("role")
        doc, label, queries = group["doc"].to_numpy(), group["label"].to_numpy(), int((group["role"].to_numpy() == 0).sum())
        if queries in (0, len(doc)):
            return None
        sets, a, b = _Sets(group["text"], shingle), [], []
        for i in range(queries):
            other = np.unique(label[sets.linked(i, queries, len(doc), percent)])
            other = other[other != label[i]]
            a += [int(label[i])] * len(other)
            b += other.tolist()
        return _pairs(a, b)

    return run


def _blocks(rows: DataFrame, percent: int, shingle: int) -> DataFrame:
    n = partitions(rows.sparkSession)
    dealt = rows.repartition(n, "fam", "qb", "mb").sortWithinPartitions("fam", "qb", "mb")
    return dealt.select("fam", "qb", "mb", "role", "doc", "label", "text").mapInArrow(grouped(_block_links(percent, shingle), ["fam", "qb", "mb"]), "a long, b long")


def _cell(salt: int, cells) -> F.Column:
    return F.pmod(F.xxhash64("doc", F.lit(salt)), cells).cast("int")


def large_family_links(members: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Components (doc, component) of the members (fam, members, doc, text) of large families."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    members = written(members.withColumn("label", F.col("doc")), "members")
    picked = members.groupBy("fam", _cell(0, F.lit(CENTRES)).alias("cell")).agg(F.min_by(F.struct("members", "doc", "label", "text"), F.xxhash64("doc", F.lit(1))).alias("r")).select("fam", "r.*")
    zero = F.lit(0).alias("qb")
    centres = picked.select("fam", zero, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("mb"), F.lit(0).alias("role"), "doc", "label", "text")
    others = members.select("fam", zero, _cell(2, blocks).alias("mb"), F.lit(1).alias("role"), "doc", "label", "text")
    links = written(_blocks(centres.unionByName(others), percent, shingle), "links")
    label = components(links).select(F.col("node").alias("doc"), "component")
    known = written(members.join(label, "doc", "left").withColumn("label", F.coalesce("component", "doc")).drop("component"), "labelled")
    sizes = known.groupBy("fam", "label").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("fam").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("most"))
    known = known.join(F.broadcast(main) if main.count() <= 100_000 else main, "fam")
    query_blocks = F.ceil((F.col("members") - F.col("most") + 1) / BLOCK).cast("int")
    queries = known.where("label <> main").select("fam", _cell(3, query_blocks).alias("qb"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("mb"), F.lit(0).alias("role"), "doc", "label", "text")
    against = known.where("members > most").select("fam", F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("qb"), _cell(2, blocks).alias("mb"), F.lit(1).alias("role"), "doc", "label", "text")
    more = written(_blocks(queries.unionByName(against), percent, shingle), "links")
    final = components(links.unionByName(more)).select(F.col("node").alias("label"), "component")
    return known.select("doc", "label").join(final, "label", "left").select("doc", F.coalesce("component", "label").alias("component"))


def _judged(rows: DataFrame, percent: int, shingle: int, family_members: int) -> DataFrame:
    """(doc, tag, n, component) of keyed rows."""
    n = partitions(rows.sparkSession)
    rows = rows.select("doc", "tag", "text")
    sketched = written(rows.mapInArrow(_sketches(shingle), "doc long, tag long, n long, s1 long, s2 long, bands array<long>"), "sketches")
    by_set = sketched.where((F.col("n") > 0) & (F.col("doc") != NO_ID)).groupBy("s1", "s2", "n").agg(F.min(F.struct("doc", "tag")).alias("rep"), F.first("bands").alias("bands"))
    classes = written(by_set.select("s1", "s2", "n", "rep.doc", "rep.tag", "bands"), "classes")
    family = families(classes)
    members = classes.join(family.select(F.col("node").alias("doc"), F.col("component").alias("fam")), "doc").select("fam", "doc", "tag", "n")
    sizes = members.groupBy("fam").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    sizes = sizes.withColumn("large", (F.col("members") > family_members) | (F.col("shingles") > FAMILY_SHINGLES))
    members = written(members.drop("n").join(sizes.drop("shingles"), "fam"), "families")
    # By shuffle at any size: the members grow with the documents.
    texts = rows.join(members.hint("shuffle_hash"), ["doc", "tag"]).select("fam", "members", "large", "doc", "text")
    texts = written(texts, "texts")  # of families only; small and large ones read it
    some = texts.where("NOT large").select("fam", "doc", "text").repartition(n, "fam").sortWithinPartitions("fam", "doc")
    part = some.mapInArrow(grouped(_whole_family(percent, shingle), ["fam"]), "a long, b long").select(F.col("a").alias("doc"), F.col("b").alias("component"))
    if members.where("large").limit(1).count():
        part = part.unionByName(large_family_links(texts.where("large").select("fam", "members", "doc", "text"), percent, shingle))
    found = part.groupBy("doc").agg(F.min("component").alias("component"))
    class_of = classes.select("s1", "s2", "n", F.col("doc").alias("rep")).join(found.withColumnRenamed("doc", "rep"), "rep", "left")
    class_of = class_of.select("s1", "s2", "n", F.coalesce("component", "rep").alias("component"))
    class_of = _joined_by_ids(sketched, class_of)
    out = sketched.select("doc", "tag", "n", "s1", "s2").join(class_of, ["s1", "s2", "n"], "left")
    named = F.when(F.col("doc") != NO_ID, F.col("component"))
    return out.select("doc", "tag", "n", F.coalesce(named, "doc").alias("component"))


def _joined_by_ids(sketched: DataFrame, class_of: DataFrame) -> DataFrame:
    """(s1, s2, n, component), with the components that rows of one doc_id belong to made one."""
    by = ["s1", "s2", "n"]
    own = F.struct(*by)
    rows = sketched.where((F.col("n") > 0) & (F.col("doc") != NO_ID))
    several = rows.groupBy("doc").agg(F.min(own).alias("low"), F.max(own).alias("high")).where("low <> high").select("doc")
    repeated = written(rows.select("doc", *by).distinct().join(several, "doc"), "repeated")
    if not repeated.limit(1).count():
        return class_of
    held = written(repeated.join(class_of, by).select("doc", "component"), "repeated")
    least = held.groupBy("doc").agg(F.min("component").alias("b"))
    joined = components(held.join(least, "doc").select(F.col("component").alias("a"), "b")).withColumnRenamed("component", "final")
    return class_of.join(joined, class_of.component == joined.node, "left").select(*by, F.coalesce("final", "component").alias("component"))


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text",
                    family_members: int = FAMILY_MEMBERS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least doc_id reachable over links of
    Jaccard similarity >= percent / 100) and kept (the document with that id)."""
    out = _judged(keyed(docs, id_col, text_col), percent, shingle, family_members)
    return out.select(given_id().alias("doc_id"), F.col("n").alias("n_shingles"), given_id("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept"))


def representatives(docs: DataFrame, percent: int = 80, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stand for their group, one for each doc_id and, without doc_id, for each text."""
    rows = keyed(docs, id_col, text_col, row=whole_row(docs))
    kept = _judged(rows, percent, shingle, FAMILY_MEMBERS).where("doc = component").select("doc", "tag").distinct()
    one = kept.where(F.col("doc") != NO_ID).groupBy("doc").agg(F.min("tag").alias("tag")).unionByName(kept.where(F.col("doc") == NO_ID))
    return rows.join(one, ["doc", "tag"]).dropDuplicates(["doc", "tag"]).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
