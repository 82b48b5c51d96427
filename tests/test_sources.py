"""Files written and read back."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_path, shared_dir, written
from millrace.sources import readers, writers


@pytest.fixture(scope="module")
def loans(spark):
    return spark.createDataFrame([(1, 35.5, 52000.0), (0, 61.0, 20100.25), (1, 18.0, 150000.0)], "approved int, age double, income double")


def test_label_first(spark, loans, tmp_path):
    path = str(tmp_path / "m")
    writers.label_first(loans.select("income", "approved", "age"), path, "approved", ["age", "income"])
    first = next(f for f in (tmp_path / "m").glob("part-*") if f.read_text()).read_text().splitlines()[0]
    assert first.startswith(("1,", "0,"))
    back = readers.label_first(spark, path, "approved", ["age", "income"])
    assert sorted(map(tuple, back.collect())) == sorted((float(a), b, c) for a, b, c in loans.collect())


def test_features_only_with_header(spark, loans, tmp_path):
    path = str(tmp_path / "b")
    writers.features_only(loans, path, "approved")
    back = readers.csv(spark, path, "age double, income double")
    assert sorted(map(tuple, back.collect())) == sorted((b, c) for _, b, c in loans.collect())


def test_overwrite_is_repeatable(spark, loans, tmp_path):
    for _ in range(2):
        writers.table(loans, str(tmp_path / "t"))
    assert readers.parquet(spark, str(tmp_path / "t")).count() == 3


def test_whole_files_and_listing(spark, tmp_path):
    texts = {"a.txt": "one\ntwo\n", "b.txt": "ünï\n\ncode", "c.pdf": "no"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "sub").mkdir()
    got = {r.document.rsplit("/", 1)[1]: r.text for r in readers.documents(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": texts["a.txt"], "b.txt": texts["b.txt"]}
    sizes = {r.name: r.size_bytes for r in readers.listing(spark, str(tmp_path)).collect()}
    assert sizes == {n: len(t.encode()) for n, t in texts.items()}
    assert {r.name for r in readers.listing(spark, str(tmp_path), "*.pdf").collect()} == {"c.pdf"}
    plan = readers.listing(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.splitlines()[0]


def test_statistics_and_constraints(spark, tmp_path):
    stats = spark.createDataFrame([("income", 1.5, 0.5, 1.0, 2.0), ("age", 35.0, 9.0, 18.0, 80.0)], "feature string, mean double, std double, min double, max double")
    writers.statistics(stats, str(tmp_path / "s"))
    doc = json.loads(next((tmp_path / "s").glob("part-*")).read_text())
    assert [f["name"] for f in doc["features"]] == ["age", "income"] and doc["features"][0]["numerical_statistics"]["mean"] == 35.0
    assert sorted(map(tuple, readers.statistics(spark, str(tmp_path / "s")).collect())) == sorted(map(tuple, stats.collect()))
    writers.constraints(spark, str(tmp_path / "c"))
    assert tuple(readers.constraints(spark, str(tmp_path / "c")).first()) == ("Robust", 0.1)


def test_captures_with_a_bad_payload(spark, tmp_path):
    event = lambda i, data, out: json.dumps({
        "captureData": {"endpointInput": {"data": data, "encoding": "CSV"}, "endpointOutput": {"data": out, "encoding": "CSV"}},
        "eventMetadata": {"eventId": i, "inferenceTime": "2024-01-15T10:30:00Z"},
    })
    (tmp_path / "x.jsonl").write_text("\n".join([event("e1", "41.25,38100,655,9050,3.5", "0.31"), event("e2", "1,2,3,4,5", "[0.12]"), event("e3", "1,,three", "?")]))
    names = ["age", "income", "credit_score", "loan_amount", "employment_years"]
    got = {r.event_id: r for r in readers.captures(spark, str(tmp_path), names).collect()}
    assert [got["e1"][n] for n in names] == [41.25, 38100.0, 655.0, 9050.0, 3.5] and got["e1"].prediction == 0.31
    assert got["e2"].prediction == 0.12 and not got["e2"].bad_payload
    assert got["e3"].bad_payload and got["e3"].age == 1.0 and got["e3"].credit_score is None and got["e3"].prediction is None
    assert got["e1"].inference_time.strftime("%H:%M") == "10:30"


def test_capture_round_trip(spark, tmp_path):
    calls = spark.range(500).select(
        "id", F.timestamp_seconds(F.lit(1705312800) + F.col("id") * 60).alias("ts"), (F.col("id") / 7).alias("x"), F.lit(2.0).alias("y")
    )
    writers.captures(calls, str(tmp_path / "c"), "id", F.col("ts"), ["x", "y"], F.col("x") / 100)
    back = readers.captures(spark, str(tmp_path / "c"), ["x", "y"])
    assert {(int(r.event_id), r.x) for r in back.collect()} == {(i, i / 7) for i in range(500)}
    assert len(list((tmp_path / "c").glob("hour=*"))) == 9
    some = writers.sampled(calls, "id", 25).count()
    assert 80 < some < 170 and writers.sampled(calls, "id", 100).count() == 500


def test_scratch_is_below_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == base and scratch_path(spark, "x") != scratch_path(spark, "x")
    kept = written(spark.range(5), "t")
    assert kept.count() == 5 and all(base in f for f in kept.inputFiles())


def test_packed_documents(spark, tmp_path):
    """Any text comes back whole from a few files, whatever it holds."""
    texts = ["one\ntwo\n", "", None, "\x1e", "\x1dB\x1e\x1dA", "\r\nü\x1d\x1d\x1e漢\n", "\n"] + [f"text {i}" for i in range(500)]
    writers.packed_documents(spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(2), str(tmp_path / "p"), "id", "text")
    got = {int(r.document): r.text for r in readers.packed_documents(spark, str(tmp_path / "p")).collect()}
    assert got == {i: t or "" for i, t in enumerate(texts)}
    assert len(list((tmp_path / "p").glob("**/part-*"))) == 2
