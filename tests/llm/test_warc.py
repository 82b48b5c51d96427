import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from millrace.llm import warc

PAGES = [
    (1, "http://a/1", "x" * 150),
    (2, "http://a/2", "x" * 150),
    (3, "http://b/3", "x" * 99),
    (4, "http://b/4", "x" * 99),
    (5, None, None),
    (6, "http://b/6\r\nX: y", ""),
    (7, "http://c/7", "é漢" * 60 + "\r\n\r\n" + "y" * 50),
    (7, "http://c/7", "é漢" * 60 + "\r\n\r\n" + "y" * 50),
    (None, "http://d/0", "x" * 150),
    (9, "http://d/9", "WARC/1.1\r\n\x1f\x8b\x08" * 40000),
    (0, "http://e/0", "z" * 100),
    (8, "http://e/8", "z" * 100),
]


def pages(spark, rows=PAGES):
    table = [(*r, "clash", b"clash", 1) for r in rows]
    return spark.createDataFrame(table, "page_id long, url string, html string, payload_digest string, payload binary, first int")


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    warc.register(spark)
    path = str(tmp_path_factory.mktemp("warc") / "out")
    warc.page_records(pages(spark).repartition(3)).write.format("warc").mode("append").save(path)
    return path


def load(spark, path, **options):
    return spark.read.format("warc").options(**options).load(path)


def test_round_trip(spark, archive):
    rows = load(spark, archive).collect()
    assert len(rows) == len(PAGES)
    smallest = {}
    for i, _, h in PAGES:
        if i is not None and h is not None and len(h.encode()) >= 100:
            smallest[h] = min(i, smallest.get(h, i))
    want = []
    for i, _, h in PAGES:
        data = (h or "").encode()
        again = i is not None and smallest.get(h, i) < i
        name = f"urn:x-page:{'' if i is None else i}"
        want.append((name, "revisit" if again else "response", f"urn:x-page:{smallest[h]}" if again else None, hashlib.sha256(data).hexdigest(), len(data), None if again else data))
    got = [(r.record_id, r.record_type, r.refers_to, r.payload_digest, r.payload_length, None if r.payload is None else bytes(r.payload)) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("split", [200, 5000])
def test_ranges_cover_every_member_once(spark, archive, split):
    small = load(spark, archive, splitBytes=split)
    assert small.rdd.getNumPartitions() >= 2
    key = ["record_id", "record_type", "payload_digest"]
    assert sorted(map(tuple, small.select(*key).collect())) == sorted(map(tuple, load(spark, archive).select(*key).collect()))


def test_filters_reach_the_headers(spark, archive):
    rows = load(spark, archive)
    assert {r.record_id for r in rows.where("record_type = 'revisit'").collect()} == {"urn:x-page:2", "urn:x-page:8"}
    assert rows.where(F.col("record_type").isin("revisit", "request") & F.col("target_uri").startswith("http://a")).count() == 1
    assert rows.where("payload_length > 100 AND record_type = 'response'").count() == 5
    plan = rows.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "Filter isnotnull" not in plan  # nothing is left to test above the scan
    blind = load(spark, archive, payload="false").collect()
    assert len(blind) == len(PAGES) and all(r.payload is None for r in blind)


def test_unwanted_members_are_not_inflated(archive):
    """A member whose payload is damaged can be passed over, and not read."""
    reader = warc.WarcReader({"path": archive})
    file = max((os.path.join(archive, f) for f in os.listdir(archive) if f.endswith(".gz")), key=os.path.getsize)
    data = bytearray(open(file, "rb").read())
    first = warc._Member(warc._Bytes(_File(bytes(data))), 0)
    assert first.length and bytes(data[first.length : first.length + 3]) == warc._MAGIC or first.length == len(data)
    reader.filters = [("record_type", "in", ("metadata",))]
    assert list(reader._members(warc._Bytes(_File(bytes(data))), 0, len(data))) == []


class _File:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at : at + n]


def test_files_of_others(spark, tmp_path):
    """Members without the length field, folded headers, plain files, uncommitted files."""
    warc.register(spark)
    block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\r\n\r\nmore"
    one = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:a>\r\nWARC-Target-URI: http://x\r\n /y\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: text/plain\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two) + gzip.compress(one))
    (tmp_path / "b.warc").write_bytes(two + one)
    (tmp_path / "c.txt").write_bytes(b"no")
    rows = load(spark, str(tmp_path)).collect()
    assert sorted((r.record_type, bytes(r.payload)) for r in rows) == [("response", b"body\r\n\r\nmore")] * 3 + [("warcinfo", b"abc")] * 2
    assert {r.target_uri for r in rows} == {"http://x /y", None}
    (tmp_path / "_committed").write_text('["b.warc"]')
    assert load(spark, str(tmp_path)).count() == 2


def test_empty(spark, tmp_path):
    warc.register(spark)
    warc.page_records(pages(spark, [])).write.format("warc").mode("append").save(str(tmp_path / "none"))
    assert load(spark, str(tmp_path / "none")).collect() == []


def test_appends_and_overwrites(spark, tmp_path):
    """Every job has a list of its own: two appends are read together, an overwrite replaces them."""
    warc.register(spark)
    path = str(tmp_path / "a")
    for k in range(3):
        warc.page_records(pages(spark, [(k, f"u{k}", "x" * 200 + str(k))])).write.format("warc").mode("append").save(path)
    assert sorted(r.target_uri for r in load(spark, path).collect()) == ["u0", "u1", "u2"]
    warc.page_records(pages(spark, [(9, "u9", "y" * 300)])).write.format("warc").mode("overwrite").save(path)
    assert [r.target_uri for r in load(spark, path).collect()] == ["u9"]
    left = sorted(f.name[:9] for f in (tmp_path / "a").iterdir() if not f.name.startswith("."))
    assert left == ["_committe", "part-" + left[1][5:9]] and len(left) == 2
