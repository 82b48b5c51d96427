"""Topics of a corpus by expectation maximisation over slices of documents.

The state is one table of masses: for every document and for every term, how many of its tokens
belong to each topic. Documents are dealt into slices by a hash of their key, as many as their length asks for; the term counts of
a slice are packed and stay where they are, in a table bucketed by slice. Terms are dealt into as many buckets. In a round a
bucket sends the masses of its terms to the slices that hold them, a slice splits its counts over the
topics and sends back one sum for each of its terms, and the bucket adds these up. So a round shuffles masses by (slice, term) and no
counts. The driver sees the total of each topic and the objective of the round, k + 1 numbers; the vocabulary stays in
Spark, whatever its size.

Masses of terms are whole multiples of 1 / UNIT (a term may have 2**31 tokens in a topic), so their sums do not depend on the order of the slices.

The objective is the log likelihood of all tokens with Dirichlet smoothing of both sides; it rises in every round.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.session import scratch_path, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DOC, TERM, CELL = 0, 1, 2
SLICE_CHARS, CHUNK_CELLS, CHUNK_NAMES = 200_000_000, 250_000, 50_000
UNIT = 2.0**32


@dataclass
class Topics:
    """Packed counts by slice, terms by bucket, their masses, and what the rounds have told."""

    k: int
    alpha: float
    beta: float
    packed: DataFrame
    owners: DataFrame
    masses: DataFrame
    totals: list[float]
    terms: int
    objective: list[float] = field(default_factory=list)

    def names(self) -> list[str]:
        return [f"m{i}" for i in range(self.k)]

    @property
    def cells(self) -> DataFrame:
        """(doc, term, n) of all documents, also of terms that are not in the vocabulary."""
        return self.packed.groupBy("place").applyInArrow(_unpacked, "doc string, term string, n long")

    def side(self, kind: int) -> DataFrame:
        """(key, m0, m1, ...) of the terms, or of the documents that have a term of the vocabulary."""
        named = self.owners.where("slice = -1") if kind == TERM else self.packed.where(F.col("kind") == DOC)
        mine = self.masses.where(F.col("kind") == kind)
        rows = ", ".join(f"{m} double" for m in self.names())
        return named.groupBy("place").cogroup(mine.groupBy("place")).applyInArrow(_named(kind, self.k), f"key string, {rows}")

    def term_shares(self) -> list:
        """Per topic the share that a term has in it, from the masses of the term."""
        return [(F.col(m) + self.beta) / (total + self.terms * self.beta) for m, total in zip(self.names(), self.totals, strict=True)]

    def document_shares(self) -> list:
        """Per topic the share that it has in a document, from the masses of the document."""
        all_of = sum((F.col(m) for m in self.names()), F.lit(0.0))
        return [(F.col(m) + self.alpha) / (all_of + self.k * self.alpha) for m in self.names()]

    def leading_terms(self, words: int = 10) -> DataFrame:
        """(topic, rank, term, weight): the terms of the largest share in each topic."""
        shares = F.array(*[F.struct(F.lit(i).alias("topic"), s.alias("weight")) for i, s in enumerate(self.term_shares())])
        listed = self.side(TERM).select(F.col("key").alias("term"), F.explode(shares).alias("s")).select("term", "s.*")
        order = W.partitionBy("topic").orderBy(F.desc("weight"), "term")
        return listed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= words).select("topic", "rank", "term", "weight")

    def of_documents(self) -> DataFrame:
        """(key, tokens, shares): the topics of every document that has a term of the vocabulary."""
        return self.side(DOC).select("key", sum((F.col(m) for m in self.names()), F.lit(0.0)).alias("tokens"), F.array(*self.document_shares()).alias("shares"))


# ---------------------------------------------------------------- packing


def _zip(x: np.ndarray) -> bytes:
    """Numbers with bytes of the same rank side by side, which makes the many zero ones cheap."""
    planes = np.ascontiguousarray(x).reshape(-1).view(np.uint8).reshape(-1, x.itemsize).T
    return pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True) if x.size else b""


def _unzip(data: bytes, kind, *shape: int) -> np.ndarray:
    item, size = np.dtype(kind).itemsize, int(np.prod(shape))
    if not size:
        return np.zeros(shape, kind)
    planes = np.frombuffer(pa.decompress(data, size * item, codec="zstd", asbytes=True), np.uint8).reshape(item, size)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind).reshape(shape)


_PACKED = pa.schema([("place", pa.int32()), ("kind", pa.int32()), ("first", pa.int32()), ("names", pa.list_(pa.string())), ("df", pa.list_(pa.int32())), ("size", pa.int32()), ("data", pa.binary())])
_PACKED_SQL = "place int, kind int, first int, names array<string>, df array<int>, size int, data binary"
_OWNED = pa.schema([("place", pa.int32()), ("slice", pa.int32()), ("names", pa.list_(pa.string())), ("size", pa.int32()), ("own", pa.binary()), ("at", pa.binary())])
_OWNED_SQL = "place int, slice int, names array<string>, size int, own binary, at binary"
_SENT = pa.schema([("place", pa.int32()), ("source", pa.int32()), ("kind", pa.int32()), ("size", pa.int32()), ("at", pa.binary()), ("data", pa.binary()), ("fit", pa.float64())])
_SENT_SQL = "place int, source int, kind int, size int, at binary, data binary, fit double"
_MASSES = pa.schema([("place", pa.int32()), ("kind", pa.int32()), ("size", pa.int32()), ("data", pa.binary()), ("totals", pa.list_(pa.float64())), ("fit", pa.float64())])
_MASSES_SQL = "place int, kind int, size int, data binary, totals array<double>, fit double"


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _rows(table: pa.Table) -> list[dict]:
    return table.to_pylist()


class _Slice:
    """Numbers of the documents and terms of one slice."""

    def __init__(self):
        self.docs: dict[str, int] = {}
        self.terms: dict[str, int] = {}
        self.df = np.zeros(0, np.int64)

    def add(self, batch: pa.RecordBatch) -> np.ndarray:
        """Document, term and count of the cells of the batch."""
        length = np.diff(batch["items"].offsets.to_numpy())
        coded = batch["items"].flatten().dictionary_encode()
        known = np.array([self.terms.setdefault(x, len(self.terms)) for x in coded.dictionary.to_pylist()], np.uint32)
        doc = np.array([self.docs.setdefault(x, len(self.docs)) for x in batch["doc"].to_pylist()], np.uint32)
        token = np.repeat(np.arange(len(length)), length) * len(known) + coded.indices.to_numpy()
        cell, n = np.unique(token, return_counts=True)
        row, code = np.divmod(cell, len(known))
        seen = np.bincount(known[code], minlength=len(self.terms))
        seen[: len(self.df)] += self.df
        self.df = seen
        return np.stack([doc[row], known[code], n.astype(np.uint32)])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    slices: dict[int, _Slice] = {}
    for batch in batches:
        place = batch["place"].to_numpy()
        for p in np.unique(place).tolist():
            part = batch if (place == p).all() else batch.filter(pa.array(place == p))
            cells = slices.setdefault(p, _Slice()).add(part)
            for a in range(0, cells.shape[1], CHUNK_CELLS):
                some = cells[:, a : a + CHUNK_CELLS]
                yield from _table([(p, CELL, 0, None, None, some.shape[1], _zip(some))], _PACKED).to_batches()
    for p, own in slices.items():
        for kind, names in ((DOC, list(own.docs)), (TERM, list(own.terms))):
            for a in range(0, len(names), CHUNK_NAMES):
                some = names[a : a + CHUNK_NAMES]
                yield from _table([(p, kind, a, some, own.df[a : a + CHUNK_NAMES].tolist() if kind == TERM else None, len(some), None)], _PACKED).to_batches()


def _own(least: int):
    """The terms of a bucket that occur in enough rows, and where each slice has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held).combine_chunks()
        for p in np.unique(whole["place"].to_numpy()).tolist():
            group = whole.filter(pa.array(whole["place"].to_numpy() == p)).combine_chunks()
            coded = group["term"].chunk(0).dictionary_encode()
            which = coded.indices.to_numpy()
            enough = np.bincount(which, group["df"].to_numpy()) >= least
            number = np.cumsum(enough) - 1
            names = coded.dictionary.filter(pa.array(enough))
            if not len(names):
                continue
            yield from pa.Table.from_arrays([pa.array([p], pa.int32()), pa.array([-1], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), pa.array([len(names)], pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())], schema=_OWNED).to_batches()
            kept = enough[which]
            where, at, own = group["slice"].to_numpy()[kept], group["at"].to_numpy()[kept], number[which[kept]]
            order = np.lexsort((at, where))
            where, at, own = where[order], at[order].astype(np.uint32), own[order].astype(np.uint32)
            starts = np.flatnonzero(np.append(True, np.diff(where) != 0))
            for a, b in zip(starts, np.append(starts[1:], len(where)), strict=True):
                yield from _table([(p, int(where[a]), None, int(b - a), _zip(own[a:b]), _zip(at[a:b]))], _OWNED).to_batches()

    return run


# ---------------------------------------------------------------- a round


def _first(k: int, seed: int):
    """First masses of the terms of a bucket, from a hash of term and topic."""

    def run(owners: pa.Table) -> pa.Table:
        out = []
        for r in _rows(owners):
            m = np.array([[2**32 + int(hashlib.md5(f"{seed}:{i}:{x}".encode()).hexdigest()[:8], 16) for x in r["names"]] for i in range(k)], np.int64)
            out.append((r["place"], TERM, r["size"], _zip(m), (m.sum(axis=1) / UNIT).tolist(), 0.0))
        return _table(out, _MASSES)

    return run


def _send(k: int):
    """The masses of a bucket, for every slice those of its terms."""

    def run(owners: pa.Table, masses: pa.Table) -> pa.Table:
        out = []
        for held in _rows(masses):
            m = _unzip(held["data"], np.int64, k, held["size"])
            for r in _rows(owners):
                own = _unzip(r["own"], np.uint32, r["size"])
                out.append((r["slice"], r["place"], TERM, r["size"], r["at"], _zip(m[:, own]), 0.0))
        return _table(out, _SENT)

    return run


def _split(model: Topics):
    """The counts of a slice split over the topics: sums by term for each bucket, and by document."""
    k, alpha, beta, terms, totals = model.k, model.alpha, model.beta, model.terms, model.totals

    def run(packed: pa.Table, sent: pa.Table) -> pa.Table:
        messages = [(r, _unzip(r["at"], np.uint32, r["size"])) for r in _rows(sent) if r["kind"] == TERM]
        many = max((int(at.max()) + 1 for _, at in messages), default=0)
        share, known = np.zeros((k, many)), np.zeros(many + 1, bool)  # the last one for terms beyond
        for r, at in messages:
            known[at] = True
            share[:, at] = (_unzip(r["data"], np.int64, k, r["size"]) / UNIT + beta) / (np.array(totals)[:, None] + terms * beta)
        docs = sum(packed["size"].filter(pa.array(packed["kind"].to_numpy() == DOC)).to_pylist())
        mixed = np.full((k, docs), 1.0 / k)  # even shares before any document has been split
        for r in _rows(sent.filter(pa.array(sent["kind"].to_numpy() == DOC))):
            m = _unzip(r["data"], np.float64, k, r["size"])
            mixed = (m + alpha) / (m.sum(axis=0) + k * alpha)
        by_term, by_doc, fit = np.zeros((k, many)), np.zeros((k, docs)), 0.0
        for j in np.flatnonzero(packed["kind"].to_numpy() == CELL).tolist():
            doc, at, n = _unzip(packed["data"][j].as_py(), np.uint32, 3, packed["size"][j].as_py())
            inside = known.take(np.minimum(at, many))
            doc, at, n = (x[inside].astype(np.intp) for x in (doc, at, n))
            part = np.empty((k, len(n)))
            for i in range(k):
                np.multiply(share[i].take(at), mixed[i].take(doc), out=part[i])
            chance = part.sum(axis=0)
            fit += float((n * np.log(chance)).sum())
            part *= n / chance
            for i in range(k):
                np.add.at(by_term[i], at, part[i])
                np.add.at(by_doc[i], doc, part[i])
        out = [(r["source"], r["place"], TERM, r["size"], None, _zip(np.rint(by_term[:, at] * UNIT).astype(np.int64)), 0.0) for r, at in messages]
        place = packed["place"][0].as_py() if packed.num_rows else None
        if place is not None:
            out.append((place, place, DOC, docs, None, _zip(by_doc), fit))
        return _table(out, _SENT)

    return run


def _gather(k: int):
    """The sums of all slices added up for the terms of a bucket; those by document go on as they are."""

    def run(owners: pa.Table, sent: pa.Table) -> pa.Table:
        out = [(r["place"], DOC, r["size"], r["data"], [0.0] * k, r["fit"]) for r in _rows(sent.filter(pa.array(sent["kind"].to_numpy() == DOC)))]
        listed = _rows(owners)
        own = {r["slice"]: _unzip(r["own"], np.uint32, r["size"]) for r in listed if r["slice"] >= 0}
        for named in (r for r in listed if r["slice"] < 0):
            m = np.zeros((k, named["size"]), np.int64)
            for r in _rows(sent.filter(pa.array(sent["kind"].to_numpy() == TERM))):
                m[:, own[r["source"]]] += _unzip(r["data"], np.int64, k, r["size"])
            out.append((named["place"], TERM, named["size"], _zip(m), (m.sum(axis=1, dtype=float) / UNIT).tolist(), 0.0))
        return _table(out, _MASSES)

    return run


def _named(kind: int, k: int):
    def run(named: pa.Table, masses: pa.Table) -> pa.Table:
        names = [x for r in sorted(_rows(named), key=lambda r: r.get("first") or 0) for x in r["names"]]
        columns = [pa.array([], pa.string()), *[pa.array([], pa.float64())] * k]
        for r in _rows(masses):
            m = _unzip(r["data"], np.int64, k, r["size"]) / UNIT if kind == TERM else _unzip(r["data"], np.float64, k, r["size"])
            held = m.any(axis=0) if kind == DOC else np.ones(len(names), bool)
            columns = [pa.array(names, pa.string()).filter(pa.array(held)), *[pa.array(x[held]) for x in m]]
        return pa.Table.from_arrays(columns, ["key", *[f"m{i}" for i in range(k)]])

    return run


def _unpacked(packed: pa.Table) -> pa.Table:
    listed = sorted(_rows(packed), key=lambda r: r["first"])
    docs, terms = (pa.array([x for r in listed if r["kind"] == kind for x in r["names"]], pa.string()) for kind in (DOC, TERM))
    doc, term, n = np.concatenate([np.zeros((3, 0), np.uint32), *[_unzip(r["data"], np.uint32, 3, r["size"]) for r in listed if r["kind"] == CELL]], axis=1)
    return pa.Table.from_arrays([docs.take(pa.array(doc)), terms.take(pa.array(term)), pa.array(n.astype(np.int64))], ["doc", "term", "n"])


# ---------------------------------------------------------------- driver


def _places(spark, n: int) -> list[int]:
    """A number for each of n partitions that the hash of the number leads to."""
    found = spark.range(40 * n + 100).select(F.col("id").cast("int").alias("id")).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id"))
    return sorted(r.id for r in found.collect())


def _dealt(places: list[int], key: str) -> Column:
    return F.element_at(F.array(*[F.lit(p) for p in places]), F.pmod(F.xxhash64(key), F.lit(len(places))).cast("int") + 1)


def _bucketed(table: DataFrame, n: int, label: str) -> DataFrame:
    """Written to the shared folder, dealt by `place`: later groupings by it need no shuffle of these rows."""
    path = scratch_path(table.sparkSession, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    table.write.format("parquet").bucketBy(n, "place").option("path", path).saveAsTable(name)
    return table.sparkSession.table(name)


def _stored(table: DataFrame, k: int) -> tuple[DataFrame, dict]:
    """The masses, written, with the totals of the terms and the fit taken on the way."""
    seen = Observation()
    totals = [F.sum(F.when(F.col("kind") == TERM, F.col("totals")[i])).alias(f"m{i}") for i in range(k)]
    out = written(table.observe(seen, *totals, F.sum(F.when(F.col("kind") == TERM, F.col("size"))).alias("terms"), F.sum("fit").alias("fit")), "masses")
    return out, seen.get


def begin(docs: DataFrame, k: int = 8, alpha: float = 0.1, beta: float = 0.01, least_documents: int = 2, seed: int = 42, doc_id: str = "doc_id", text: str = "text", slice_chars: int = SLICE_CHARS) -> Topics:
    """Term counts of all documents, and first masses from a hash of term and topic."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.length(text))).first()[0] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-size // slice_chars))
    places = _places(spark, n)
    # Rows that repeat an id are one document here, and so are rows without one.
    keyed = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"), F.col(text).alias("text"))
    dealt = keyed.withColumn("place", _dealt(places, "doc")).repartition(n, "place")
    listed = dealt.select("place", "doc", tx.terms(F.col("text")).alias("items"))
    packed = _bucketed(listed.mapInArrow(_pack, _PACKED_SQL), n, "slices")
    terms = packed.where(F.col("kind") == TERM).select(F.col("place").alias("slice"), "first", F.posexplode(F.arrays_zip("names", "df")).alias("at", "_t"))
    spread = terms.select("slice", (F.col("first") + F.col("at")).alias("at"), F.col("_t.names").alias("term"), F.col("_t.df").alias("df"))
    owned = spread.withColumn("place", _dealt(places, "term")).repartition(n, "place").mapInArrow(_own(least_documents), _OWNED_SQL)
    owners = _bucketed(owned, n, "owners")
    masses, told = _stored(owners.where("slice = -1").groupBy("place").applyInArrow(_first(k, seed), _MASSES_SQL), k)
    if not told["terms"]:
        raise ValueError("no term occurs in enough documents")
    return Topics(k, alpha, beta, packed, owners, masses, [told[f"m{i}"] for i in range(k)], told["terms"])


def _summed(model: Topics) -> DataFrame:
    """The masses after a round, of which only masses are shuffled."""
    k, by = model.k, lambda table: table.groupBy("place")
    down = by(model.owners.where("slice >= 0")).cogroup(by(model.masses.where(F.col("kind") == TERM))).applyInArrow(_send(k), _SENT_SQL)
    if model.objective:
        nothing = F.lit(None).cast("binary")
        docs = model.masses.where(F.col("kind") == DOC).select("place", F.col("place").alias("source"), "kind", "size", nothing.alias("at"), "data", F.lit(0.0).alias("fit"))
        down = down.unionByName(docs)
    up = by(model.packed.where(F.col("kind") != TERM).select("place", "kind", "size", "data")).cogroup(by(down)).applyInArrow(_split(model), _SENT_SQL)
    return by(model.owners.select("place", "slice", "size", "own")).cogroup(by(up)).applyInArrow(_gather(k), _MASSES_SQL)


def refine(model: Topics, limit: int = 0) -> Topics:
    """One round over all documents. Nothing is broadcast at any size, so `limit`, the terms up to which it once was, decides nothing."""
    masses, told = _stored(_summed(model), model.k)
    totals = [told[m] for m in model.names()]
    return Topics(model.k, model.alpha, model.beta, model.packed, model.owners, masses, totals, told["terms"], [*model.objective, told["fit"]])


def objective(model: Topics) -> float:
    """Smoothed log likelihood of all tokens under the shares of the model; rises from round to round."""
    terms = model.side(TERM).select(F.col("key").alias("term"), *[s.alias(f"t{i}") for i, s in enumerate(model.term_shares())])
    docs = model.side(DOC).select(F.col("key").alias("doc"), *[s.alias(f"d{i}") for i, s in enumerate(model.document_shares())])
    chance = sum((F.col(f"t{i}") * F.col(f"d{i}") for i in range(model.k)), F.lit(0.0))
    fit = model.cells.join(terms, "term").join(docs, "doc").agg(F.sum(F.col("n") * F.ln(chance))).first()[0]
    prior_t = terms.agg(F.sum(sum((F.ln(f"t{i}") for i in range(model.k)), F.lit(0.0)))).first()[0]
    prior_d = docs.agg(F.sum(sum((F.ln(f"d{i}") for i in range(model.k)), F.lit(0.0)))).first()[0]
    return fit + model.beta * prior_t + model.alpha * prior_d


def topics(docs: DataFrame, k: int = 8, words: int = 10, rounds: int = 10, **settings) -> DataFrame:
    """(topic, rank, term, weight): the leading terms of k topics."""
    model = begin(docs, k, **settings)
    for _ in range(rounds):
        model = refine(model)
    return model.leading_terms(words)
