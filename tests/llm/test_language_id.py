from pyspark.sql import functions as F

from millrace.llm import language_id
from millrace.llm.common import crc_fold
from tests.llm.odd import ROWS, empty, frame

SYLLABLES = {"aa": "ka no mi ru to".split(), "bb": "stra wen gro lich ßen".split(), "cc": "élo què vra mont ñi".split()}


def corpus(n=240):
    out = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3] if i % 9 else "aa"
        parts = SYLLABLES[lang]
        text = " ".join("".join(parts[(i * 31 + k * k + j) % 5] for j in range(k % 3 + 1)) for k in range(5 + i % 60))
        out.append((i, None if i % 11 == 5 else text, None if i % 13 == 0 else lang))
    return out


def test_held_out_accuracy(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    fold = crc_fold(F.col("doc_id"), 4)
    out = language_id.predict(docs, language_id.fit(docs, fold != 2), [F.col("doc_id"), F.col("lang"), (fold == 2).alias("held"), F.col("text")]).collect()
    assert len(out) == 240 and all(0 <= r.score <= 1 for r in out)
    assert all((r.lang_pred == "und") == (r.text is None) for r in out)
    held = [r for r in out if r.held and r.lang and r.text]
    assert len(held) > 30 and sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = crc_fold(F.col("doc_id"), 4)
    out = language_id.predict(docs, language_id.fit(docs, fold != 2), [F.col("lang"), (fold == 2).alias("held")])
    right, n = out.where("held").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 200 and right >= 0.97


def test_labels_of_held_out_rows_play_no_part(spark):
    docs = spark.createDataFrame(corpus(120), "doc_id long, text string, lang string")
    fold = crc_fold(F.col("doc_id"), 4)
    other = docs.withColumn("lang", F.when(fold == 2, "zz").otherwise(F.col("lang")))
    a, b = (language_id.predict(d, language_id.fit(d, fold != 2), [F.col("doc_id")]).orderBy("doc_id").collect() for d in (docs, other))
    assert a == b


def test_odd_rows(spark):
    docs = frame(spark)
    out = language_id.predict(docs, language_id.fit(docs, F.lit(True)), [F.struct("*").alias("row")])
    got = [(r.row.text, r.lang_pred) for r in out.collect()]
    assert sorted((t for t, _ in got), key=repr) == sorted((t for _, t in ROWS), key=repr)
    assert all((p == "und") == (not any(c.isalpha() for c in t or "")) for t, p in got)
    digits = spark.createDataFrame([(1, "123 !"), (2, "漢字")], "doc_id long, text string")
    model = language_id.fit(docs, F.lit(True))
    assert [r.lang_pred == "und" for r in language_id.predict(digits, model, [F.col("doc_id")]).orderBy("doc_id").collect()] == [True, False]


def test_nothing_to_learn_from(spark):
    assert language_id.fit(empty(spark), F.lit(True)) is None
    out = language_id.predict(frame(spark), language_id.fit(frame(spark), F.lit(False)), [F.col("doc_id")]).collect()
    assert len(out) == len(ROWS) and {(r.lang_pred, r.score) for r in out} == {("und", 0.0)}
    model = language_id.fit(frame(spark), F.lit(True))
    assert language_id.predict(empty(spark), model, [F.col("doc_id")]).collect() == []
