import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity
from millrace.llm.common import Words, crc_fold, text_buffers
from tests.llm.odd import ROWS, empty, frame, prose


def hashes(*texts):
    return toxicity._word_hashes(list(texts)).tolist()


def test_folding():
    assert len(set(hashes("idiot", "IDIOT", "1d1ot", "id!ot!", "i.d.i.o.t", "Idiot!!", '"idiot",'))) == 1
    assert len(set(hashes("idiot", "idiots", "toidi"))) == 3
    data, offsets = text_buffers(pa.array(["...", "", "!!"]))
    assert len(toxicity.folded(Words(data, offsets))) == 2


def test_features():
    texts = ["You absolute IDIOT, you!!", "a quiet text of six words", "", "stuuupid w0rd in-side a,b"]
    data, offsets = text_buffers(pa.array(texts))
    word = np.array(sorted(hashes("idiot")), np.uint64)
    x = toxicity.features(data, offsets, word, np.array([3.0]))
    row = [dict(zip(toxicity.NAMES, r)) for r in x]
    assert row[0]["hits"] == 0.25 and row[0]["strongest"] == 3 and row[0]["near_second"] == 1 and row[0]["nearest"] == 0.5
    assert row[0]["second"] == 0.5 and row[0]["shouted"] == 0.25 and row[0]["exclaimed"] > 0
    assert not row[1]["hits"] and not row[1]["mixed"] and not x[2].any()
    assert row[3]["stretched"] > 0 and row[3]["mixed"] == 0.25 and row[3]["symbols_inside"] == 0.5


def planted(n):
    rude = ["moron", "scum", "worthless"]
    out = []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(i, 30 + i % 50, 60)
        if bad:
            w = text.split()
            for k in range(3):
                w.insert((i + 11 * k) % len(w), rude[(i // 4 + k) % 3])
            text = " ".join(w)
        out.append((i, text, int(bad)))
    return out


@pytest.fixture(scope="module")
def learned(spark):
    rows = planted(500)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, b) for i, _, b in rows if i % 10], "doc_id long, toxic int")
    return docs, labels


def test_held_out_ranking(spark, learned):
    docs, labels = learned
    out = toxicity.scored(docs, labels, crc_fold(F.col("doc_id"), 5) != 0).join(labels, "doc_id").where(crc_fold(F.col("doc_id"), 5) == 0).collect()
    good, bad = [[r.score for r in out if r.toxic == k] for k in (0, 1)]
    assert len(bad) > 10 and np.mean([[b > g for g in good] for b in bad]) > 0.95
    assert np.mean([(r.score >= 0.5) == bool(r.toxic) for r in out]) > 0.95


def test_odd_rows(spark, learned):
    docs = frame(spark)
    _, labels = learned
    out = toxicity.scored(docs, labels, F.lit(True)).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    repeated = labels.unionByName(labels).unionByName(labels.withColumn("toxic", F.lit(None).cast("int")))
    assert toxicity.sample_rows(docs, repeated, F.lit(True), "doc_id", "text", "toxic").count() <= len(ROWS)


def test_one_class_or_none(spark, learned):
    docs, labels = learned
    assert {r.score for r in toxicity.scored(docs, labels.limit(0), F.lit(True)).select("score").distinct().collect()} == {0.0}
    assert {r.score for r in toxicity.scored(docs, labels.where("toxic = 1"), F.lit(True)).select("score").distinct().collect()} == {1.0}
    assert toxicity.scored(empty(spark), labels, F.lit(True)).collect() == []
