"""Column functions against plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import numeric as nx, text as tx, time as tm

TEXTS = [
    "", "   ", "one", " two\twords\n", "a b c　d", "x\x0by\x0cz\x1cq\x85r", "Émile, où est-tu? 123 don't",
    "a b a b a", "word " * 5200, "é" * 12001,
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate([*TEXTS, None])], "i int, s string")


def test_words_match_python_split(texts):
    got = {r.i: r.w for r in texts.select("i", tx.words(F.col("s")).alias("w")).collect()}
    assert all(got[i] == s.split() for i, s in enumerate(TEXTS))
    assert got[len(TEXTS)] is None


def test_segments_keep_the_whole_text(texts):
    for r in texts.where("s IS NOT NULL").select("s", tx.segments(F.col("s"), 5000).alias("p")).collect():
        assert "".join(r.p) == r.s
        assert all(len(p) <= 5000 for p in r.p) and len(r.p) == max(1, math.ceil(len(r.s) / 5000))


def test_runs_count_items(texts):
    listed = texts.select("s", F.sort_array(tx.terms(F.col("s"))).alias("t"))
    for r in listed.select("s", tx.runs("t").alias("n")).collect():
        words = [] if r.s is None else __import__("regex").findall(r"\p{L}+", r.s.lower())
        assert {x["item"]: x["n"] for x in r.n or []} == {w: words.count(w) for w in words}


def test_titles(spark):
    names = ["Alder, Mr. Tom", "Cedar, Miss. Eve", "No title here", "Elm, Dona. Ines", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(tx.title_of(F.col("n"))).collect()] == ["Mr", "Miss", None, "Dona", None]


def test_paths(spark):
    df = spark.createDataFrame([("docs/uploads/a.b.txt",), ("docs/uploads/plain",)], "p string")
    p = F.col("p")
    got = df.select(
        tx.basename(p), tx.extension(p), tx.strip_extension(p),
        tx.derived_path(p, "uploads/", "processed/analysis/", "_analysis.json"),
    ).collect()
    assert tuple(got[0]) == ("a.b.txt", "txt", "docs/uploads/a.b", "docs/processed/analysis/a.b_analysis.json")
    assert tuple(got[1]) == ("plain", None, "docs/uploads/plain", "docs/processed/analysis/plain_analysis.json")


def test_payloads(spark):
    df = spark.createDataFrame([("35.5,52000,710", "[0.78]"), ("1,x", "0.5"), (None, "nope")], "data string, out string")
    rows = df.select(tx.parse_payload(F.col("data"), ["a", "b", "c"]).alias("f"), tx.parse_score(F.col("out")).alias("p")).collect()
    assert [tuple(r.f) for r in rows] == [(35.5, 52000.0, 710.0), (1.0, None, None), (None, None, None)]
    assert [r.p for r in rows] == [0.78, 0.5, None]


def test_numeric(spark):
    df = spark.createDataFrame([(0.0, 5.0, "b"), (10.0, 12.0, "z"), (None, 1.0, None)], "a double, b double, c string")
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    rows = df.select(
        nx.change_pct(a, b).alias("pct"), nx.clip(a, 1.0, 4.0).alias("clip"), nx.map_encode(c, {"a": 0, "b": 1}).alias("map"),
        nx.case_encode(c, {"a": 0, "b": 1}, 9).alias("case"), nx.collapse(c, {"group": ["b", "q"]}).alias("col"),
        nx.threshold_class(F.lit(0.5)).alias("cls"), nx.confidence(F.lit(0.25)).alias("conf"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (None, 1.0, 1, 1, "group", 0, 0.75), (20.0, 4.0, None, 9, "z", 0, 0.75), (None, None, None, 9, None, 0, 0.75),
    ]


def test_hash_bucket_is_md5(spark):
    import hashlib

    got = [r[0] for r in spark.range(200).select(nx.hash_bucket(F.col("id"), 100, 42)).collect()]
    assert got == [int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) % 100 for i in range(200)]


def test_epochs(spark):
    df = spark.createDataFrame([(1704067207.179575,)], "s double")
    r = df.select(tm.iso(tm.from_epoch(F.col("s"))).alias("iso"), tm.to_epoch(tm.from_epoch(F.col("s"))).alias("s")).first()
    assert (r.iso, r.s) == ("2024-01-01T00:00:07", 1704067207.179575)
