"""Each stage on its own input against a plain version, and the whole on odd rows."""

import pytest
import corpus_pipeline
from millrace.llm import sentencepiece_codec
from tests.llm import test_decontamination, test_near_dedup, test_secret_scan
from tests.llm.odd import empty, frame

FOLDER = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        after = f(spark, docs, FOLDER)
        out.append((name, docs, after))
        if name != corpus_pipeline.STAGES[-1][0]:
            path = corpus_pipeline.written(after, "stage")
            docs = path
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay(spark, stages):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, _, after in stages[:-1]:
        assert after.columns == given.columns and after.dtypes == given.dtypes


def test_every_stage_against_a_plain_version(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    for name, before, after in stages:
        rows = [(r.doc_id, r.text) for r in before.collect()]
        if name == "language_id":
            kept = set(ids(after))
            clear = {i for i, t in rows if any(c.isalpha() for c in t or "")}
            assert kept <= clear and len(kept) >= 0.98 * len(clear)
        elif name == "near_dedup":
            assert ids(after) == sorted(i for i, _, c, _ in test_near_dedup.brute(rows, 80) if i == c)
        elif name == "decontamination":
            held = {d for d, *_ in test_decontamination.brute(rows, items)}
            assert held and ids(after) == sorted(i for i, _ in rows if i not in held)
        elif name == "secret_scans":
            got = {r.doc_id: r for r in after.collect()}
            assert len(got) == len(rows)
            for i, t in rows:
                found = test_secret_scan.brute(t)
                assert got[i].n_chars == len(got[i].text)
                assert (got[i].text == t) == (not found)
                assert all(f"[{kind}]" in got[i].text for _, _, kind, _ in found[:1])
        else:
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL_PATH)
            got = {r.doc_id: r.ids for r in after.collect()}
            assert got == {i: sp.encode(t) for i, t in rows}


def test_run_is_its_stages(spark, stages):
    out = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, out.select("doc_id", "n_tokens").collect())) == sorted(map(tuple, stages[-1][2].select("doc_id", "n_tokens").collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_in_every_stage(spark, name):
    rows = frame(spark).unionByName(frame(spark))
    assert STAGE[name](spark, rows, FOLDER).count() > 0
    none = STAGE[name](spark, empty(spark), FOLDER)
    assert none.collect() == []
    if name != "sentencepiece":
        assert none.columns == rows.columns


def test_secrets_and_unclear_language(spark):
    docs = spark.createDataFrame([(1, "12345 --", "en"), (2, None, None), (3, "the password: hunter22 was the one", "en")], "doc_id long, text string, lang string")
    kept = corpus_pipeline.identify_language(spark, docs, FOLDER)
    assert ids(kept) == [3]
    assert corpus_pipeline.redact_secrets(spark, kept, FOLDER).first().text == "the [assign] was the one"
