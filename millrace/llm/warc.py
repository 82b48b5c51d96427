"""WARC archives as a Spark data source, read and written on the executors.

Format `warc` (register it with :func:`register`). Writing: every record is a gzip member
whose extra field holds the member's length ("SL"); a task writes files of its own, and the
commit lists them in a file `_committed-<job>`, so files of failed or repeated attempts are never
read. Readers take the files of all lists, so jobs may append one after the other; a job that overwrites
adds its list and then deletes the older ones with their files. Reading: files are planned as byte ranges; a range owns the members that begin
in it. For each member the record headers are inflated first. Filters on record type, URI,
ids, digest and sizes are pushed down to them, and the rest of an unwanted member is passed over
by its length without inflating it (members without the field are inflated to find
their end). Option `payload=false` leaves payloads undecoded altogether. Plain `.warc` files are read
whole, by Content-Length.

Defined results: a null payload is empty; records without a header give null for it;
an empty folder gives no rows.
"""

from __future__ import annotations

import io
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage,
)

from millrace.session import scratch_path

SCHEMA = """record_id string, record_type string, target_uri string, date string, refers_to string,
 payload_digest string, payload_length long, content_type string, content_length long, payload binary"""
# The WARC field behind each column; payload length is a field of our own.
FIELDS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
    "content_type": "Content-Type",
    "content_length": "Content-Length",
}
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPLIT_BYTES, FILE_BYTES, BATCH_BYTES, READ_BYTES = 64 << 20, 1 << 30, 8 << 20, 1 << 20
LEVEL = 3
COMMITTED = "_committed"
_MAGIC = b"\x1f\x8b\x08"


def register(spark) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def _arrow(value_type: str) -> pa.DataType:
    return {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[value_type]


COLUMNS = {c.split()[0]: _arrow(c.split()[1]) for c in SCHEMA.split(",")}


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], overwrite)


# ---------------------------------------------------------------- writing


class _Committed(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


def record(row: dict) -> bytes:
    """One record of WARC 1.1 as a gzip member that knows its length."""
    payload = row.get("payload") or b""
    kind = row["record_type"]
    block = b"" if kind == "revisit" else payload
    if kind == "response":
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    values = {c: row.get(c) for c in FIELDS}
    values |= {"content_length": len(block), "content_type": "application/http; msgtype=response"}
    head = ["WARC/1.1"]
    for column, field in FIELDS.items():
        value = values[column]
        if value is None:
            continue
        if column in ("record_id", "refers_to"):
            value = f"<{value}>"
        elif column == "payload_digest":
            value = f"sha256:{value}"
        head.append(f"{field}: {_one_line(str(value))}")
    if kind == "revisit":
        head.append(f"WARC-Profile: {IDENTICAL}")
    pressed = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    plain = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    body = pressed.compress(plain) + pressed.flush()
    length = 10 + 2 + 8 + len(body) + 8
    extra = b"SL" + struct.pack("<HI", 4, length & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


def _one_line(value: str) -> str:
    return value.replace("\r", " ").replace("\n", " ")


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool = False):
        self.path, self.overwrite, self.list = path, overwrite, f"{COMMITTED}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, base = fs.FileSystem.from_uri(self.path)
        store.create_dir(base, recursive=True)
        files, out = [], None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out = store.open_output_stream(f"{base}/{files[-1]}", compression=None)
                out.write(record(row))
                if out.tell() >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return _Committed(files)

    def commit(self, messages) -> None:
        store, base = fs.FileSystem.from_uri(self.path)
        store.create_dir(base, recursive=True)
        older = _lists(store, base) if self.overwrite else {}
        with store.open_output_stream(f"{base}/{self.list}") as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())
        for path, names in older.items():
            store.delete_file(path)
            for name in names:
                if store.get_file_info(f"{base}/{name}").type == fs.FileType.File:
                    store.delete_file(f"{base}/{name}")

    def abort(self, messages) -> None:
        store, base = fs.FileSystem.from_uri(self.path)
        for f in [f for m in messages if m for f in m.files]:
            store.delete_file(f"{base}/{f}")


# ---------------------------------------------------------------- reading


def _lists(store: fs.FileSystem, base: str) -> dict[str, list[str]]:
    """The commit lists of a folder and the files that they name."""
    out = {}
    for info in store.get_file_info(fs.FileSelector(base)):
        if os.path.basename(info.path).startswith(COMMITTED):
            with store.open_input_stream(info.path) as listed:
                out[info.path] = json.loads(listed.read())
    return out


class _Range(InputPartition):
    def __init__(self, ranges: list[tuple[str, int, int]]):
        self.ranges = ranges


class _Bytes:
    """A file read in chunks."""

    def __init__(self, file):
        self.file, self.size, self.at, self.chunk = file, file.size(), 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if not (self.at <= at and at + n <= self.at + len(self.chunk)):
            self.chunk, self.at = self.file.read_at(min(max(n, READ_BYTES), self.size - at), at), at
        return self.chunk[at - self.at : at - self.at + n]


class _Member:
    """The gzip member at one place: headers first, the rest on demand."""

    def __init__(self, data: _Bytes, at: int):
        self.data, self.at, self.fed, self.text = data, at, at, b""
        self.zip = zlib.decompressobj(31)
        head = data.get(at, 20)
        self.length = None
        if len(head) >= 20 and head[3] == 4 and head[12:14] == b"SL":
            self.length = struct.unpack("<I", head[16:20])[0] or None
        self._inflate(lambda: b"\r\n\r\n" in self.text, 2048)

    def _inflate(self, enough, most: int, keep: bool = True) -> None:
        while not self.zip.eof and not enough():
            pending = self.zip.unconsumed_tail
            if not pending:
                pending = self.data.get(self.fed, 65536)
                self.fed += len(pending)
                if not pending:
                    raise EOFError("a record ends early")
            piece = self.zip.decompress(pending, most)
            self.text = self.text + piece if keep else b""

    def block(self, n: int) -> bytes:
        start = self.text.index(b"\r\n\r\n") + 4
        out = io.BytesIO()
        out.write(self.text[start:])
        while not self.zip.eof and out.tell() < n:
            self.text = b""
            self._inflate(lambda: bool(self.text), 1 << 20)
            out.write(self.text)
        return out.getvalue()[:n]

    def end(self) -> int:
        if self.length:
            return self.at + self.length
        self._inflate(lambda: False, 1 << 20, keep=False)
        return self.fed - len(self.zip.unused_data)


def parse_headers(text: bytes) -> dict[str, str]:
    lines: list[str] = []
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and lines:
            lines[-1] += " " + line.strip()
        elif line:
            lines.append(line)
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _columns(text: bytes) -> dict:
    found = parse_headers(text)
    row = {c: found.get(f.lower()) for c, f in FIELDS.items()}
    for c in ("record_id", "refers_to"):
        row[c] = row[c].strip("<>") if row[c] else row[c]
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].rpartition(":")[2]
    for c in ("payload_length", "content_length"):
        row[c] = int(row[c]) if row[c] is not None and row[c].isdigit() else None
    return row


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.filters = options["path"], []
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.split = int(options.get("splitBytes", SPLIT_BYTES))

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = ".".join(f.attribute) if hasattr(f, "attribute") else None
            if column in FIELDS and isinstance(f, EqualTo):
                self.filters.append((column, "in", (f.value,)))
            elif column in FIELDS and isinstance(f, In):
                self.filters.append((column, "in", tuple(f.value)))
            elif column in FIELDS and isinstance(f, StringStartsWith):
                self.filters.append((column, "starts", f.value))
            elif column in FIELDS and isinstance(f, IsNotNull):
                self.filters.append((column, "given", None))
            else:
                yield f

    def _wanted(self, row: dict) -> bool:
        def holds(value, how: str, wanted) -> bool:
            return value in wanted if how == "in" else value is not None and (how == "given" or value.startswith(wanted))

        return all(holds(row[c], how, wanted) for c, how, wanted in self.filters)

    def partitions(self) -> list[InputPartition]:
        store, base = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(base)
        if info.type == fs.FileType.File:
            files = [info]
        else:
            files = [f for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith((".warc", ".warc.gz"))]
            if lists := _lists(store, base):
                names = {n for listed in lists.values() for n in listed}
                files = [f for f in files if os.path.basename(f.path) in names]
        ranges = []
        for f in sorted(files, key=lambda f: f.path):
            step = self.split if f.path.endswith(".gz") else max(f.size, 1)
            ranges += [(f.path, a, min(a + step, f.size)) for a in range(0, f.size, step)]
        groups: list[list] = []
        room = 0
        for r in ranges:  # small files share a partition
            if not groups or room + r[2] - r[1] > self.split:
                groups.append([])
                room = 0
            groups[-1].append(r)
            room += r[2] - r[1]
        return [_Range(g) for g in groups] or [_Range([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        store, _ = fs.FileSystem.from_uri(self.path)
        for path, first, last in partition.ranges:
            with store.open_input_file(path) as file:
                for row in (self._members if path.endswith(".gz") else self._plain)(_Bytes(file), first, last):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 200
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _members(self, data: _Bytes, at: int, last: int) -> Iterator[dict]:
        if at:
            at = _next_member(data, at, last)
        while at is not None and at < last:
            member = _Member(data, at)
            row = _columns(member.text.partition(b"\r\n\r\n")[0])
            if self._wanted(row):
                row["payload"] = _payload(row, member.block(row["content_length"] or 0)) if self.payload else None
                yield row
            at = member.end()

    def _plain(self, data: _Bytes, at: int, last: int) -> Iterator[dict]:
        while at < last:
            head, n = b"", READ_BYTES // 64
            while b"\r\n\r\n" not in head:
                head, n = data.get(at, n), n * 2
                if b"\r\n\r\n" not in head and at + len(head) >= data.size:
                    return
            text = head.partition(b"\r\n\r\n")[0]
            row = _columns(text)
            body = at + len(text) + 4
            if self._wanted(row):
                row["payload"] = _payload(row, data.get(body, row["content_length"] or 0)) if self.payload else None
                yield row
            at = body + (row["content_length"] or 0) + 4


def _payload(row: dict, block: bytes) -> bytes | None:
    if row["record_type"] == "revisit":
        return None
    if (row["content_type"] or "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _next_member(data: _Bytes, at: int, last: int) -> int | None:
    """First place from `at` on where a gzip member that holds a record begins."""
    while at < last:
        chunk = data.get(at, READ_BYTES)
        hit = chunk.find(_MAGIC)
        if hit < 0:
            at += max(len(chunk) - 2, 1)
            continue
        at += hit
        try:
            if zlib.decompressobj(31).decompress(data.get(at, 4096), 16).startswith(b"WARC/"):
                return at
        except zlib.error:
            pass
        at += 1
    return None


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in COLUMNS.items()], list(COLUMNS))


# ---------------------------------------------------------------- archives of pages

REVISIT_BYTES = 100


def page_records(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Records of pages: of equal payloads of at least `least` bytes the one with the least
    id is a response and the others refer to it. A page without id is always a response;
    rows that repeat an id and a payload have the same type."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("target_uri"), F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_length"))
    keys = rows.where(F.col("payload_length") >= least).select("id", "payload_digest")
    first = keys.groupBy("payload_digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = F.col("first") < F.col("id")
    name = lambda c: F.concat(F.lit("urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")))
    return rows.join(first, "payload_digest", "left").select(
        name(F.col("id")).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.lit("1970-01-01T00:00:00Z").alias("date"), F.when(again, name(F.col("first"))).alias("refers_to"), "payload_digest", "payload_length",
        F.lit(None).cast("string").alias("content_type"), F.lit(None).cast("long").alias("content_length"), F.when(~F.coalesce(again, F.lit(False)), F.col("payload")).alias("payload"))


def query(spark, sf_dir: str) -> DataFrame:
    register(spark)
    path = scratch_path(spark, "warc")
    page_records(spark.read.parquet(f"{sf_dir}/pages.parquet")).write.format("warc").mode("append").save(path)
    back = spark.read.format("warc").load(path).where(F.col("record_type").isin("response", "revisit"))
    number = lambda c: F.substring_index(c, ":", -1).try_cast("long")
    own = F.col("record_type") == "response"
    return back.select(
        number(F.col("record_id")).alias("page_id"), F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", number(F.col("refers_to")).alias("refers_to"))


SQL = """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= 100"""
