"""Document analytics on six small texts and on edge rows."""

import math
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from millrace.operators import blocks, documents as dx
from millrace.plans import documents as plans, large
from tests.conftest import rows

TEXTS = {
    "email.txt": "Hello, my parcel from the shop in Lyon has not arrived. Please write to anna.berg@example.org or call.",
    "staff.txt": "Dr. Weber said costs fell 12% to $4,500 since March 3, 2024. Maria Lopez thanked the team, great work, great team.",
    "angry.txt": "Terrible service. The screen is broken, support is awful and slow. I hate the awful delay. Terrible.",
    "plain.txt": "The lamp is fine. It is good in the hall but bad in the dark. Shipping took 3 days.",
    "happy.txt": "I love this excellent product. Great quality, excellent help, great price. I love it!",
    "ticket.txt": "Ticket 48213: version 2.4 fails on host 10.0.0.12 since 2024-01-15, see https://status.example.org/48213 now.",
}
WORDS = [
    ("love", 1.0), ("excellent", 1.0), ("great", 1.0), ("good", 1.0), ("terrible", -1.0), ("awful", -1.0), ("hate", -1.0),
    ("broken", -1.0), ("bad", -1.0), ("slow", -0.8), ("the", 0.01), ("unused", 5.0),
]


@pytest.fixture(scope="module")
def docs(spark):
    table = [(i, k, v) for i, (k, v) in enumerate(TEXTS.items())] + [(90, "empty.txt", ""), (91, "scan.pdf", "binary"), (92, "long.txt", "great day " * 3000)]
    return spark.createDataFrame(table, "doc_id bigint, name string, text string").repartition(3)


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(WORDS, "term string, weight double")


def letters(text):
    return regex.findall(r"\p{L}+", text.lower())


def test_text_stats(docs):
    got = {r.doc_id: (r.text_length, r.word_count) for r in dx.text_stats(docs).collect()}
    assert got == {r.doc_id: (len(r.text), len(r.text.split())) for r in docs.collect()}


@pytest.mark.parametrize("limit", [1000, 0])
def test_sentiment(docs, lexicon, limit):
    got = {r.doc_id: r for r in dx.sentiment(docs, lexicon, 0.1, limit=limit).collect()}
    weights = dict(WORDS)
    for d in docs.collect():
        found = letters(d.text)
        p = sum(weights.get(w, 0) > 0.1 for w in found)
        n = sum(weights.get(w, 0) < -0.1 for w in found)
        m = 2 * min(p, n)
        total = len(found) + m
        want = [p / total, n / total, (len(found) - p - n) / total, m / total] if total else [0, 0, 1, 0]
        r = got[d.doc_id]
        assert [r.positive, r.negative, r.neutral, r.mixed] == pytest.approx(want, abs=1e-6)
        assert r.sentiment == dx.SENTIMENTS[max(range(4), key=lambda i: (round(want[i], 6), -i))]
    assert got[92].sentiment == "POSITIVE" and got[90].sentiment == "NEUTRAL"


def test_learned_lexicon(spark):
    docs = spark.createDataFrame([(1, "good good fine"), (2, "bad fine"), (3, "never labelled")], "doc_id int, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id int, quality int")
    got = {r.term: r.weight for r in dx.learn_lexicon(docs, labels, "quality").collect()}
    want = {"good": math.log(3 / 6) - math.log(1 / 5), "fine": math.log(2 / 6) - math.log(2 / 5), "bad": math.log(1 / 6) - math.log(2 / 5)}
    assert got == {k: round(v, 6) for k, v in want.items()}


def test_entities(docs):
    by_doc = {}
    for r in dx.entities(docs).collect():
        by_doc.setdefault(r.doc_id, Counter())[(r.type, r.text)] += 1
    assert ("OTHER", "anna.berg@example.org") in by_doc[0]
    assert {("PERSON", "Dr. Weber"), ("QUANTITY", "12%"), ("QUANTITY", "$4,500"), ("DATE", "March 3, 2024"), ("PERSON", "Maria Lopez")} <= set(by_doc[1])
    assert {("DATE", "2024-01-15"), ("LOCATION", "10.0.0.12"), ("OTHER", "https://status.example.org/48213"), ("QUANTITY", "48213")} <= set(by_doc[5])
    assert by_doc[5][("QUANTITY", "48213")] == 2 and 90 not in by_doc
    merged = {(r.type, r.text): r.mentions for r in dx.entities_by_type(dx.entities(docs)).collect()}
    assert merged == sum(by_doc.values(), Counter())


def test_guards_change_nothing(docs):
    bare = [(k, p, s, "") for k, p, s, _ in dx.ENTITY_PATTERNS]
    assert rows(dx.entities(docs)) == rows(dx.entities(docs, bare))


@pytest.mark.parametrize("limit", [100_000, 0])
def test_key_phrases(docs, limit):
    table = {d.doc_id: letters(d.text) for d in docs.collect()}
    counts = {i: Counter(f"{a} {b}" for a, b in zip(t, t[1:])) for i, t in table.items()}
    df = Counter(p for c in counts.values() for p in c)
    want = set()
    for i, c in counts.items():
        scored = sorted(((round(n * math.log((len(table) + 1) / (df[p] + 1)), 6), p) for p, n in c.items()), key=lambda x: (-x[0], x[1]))
        want |= {(i, p, s, k) for k, (s, p) in enumerate(scored[:4], 1)}
    got = {(r.doc_id, r.phrase, r.score, r.rank) for r in dx.key_phrases(docs, 4, limit=limit).collect()}
    assert got == want


def test_long_texts_are_counted_to_the_end(docs):
    got = {r.term: r.n for r in dx.term_counts(docs).where("doc_id = 92").collect()}
    assert got == {"great": 3000, "day": 3000}
    assert dx.pieces(docs).where("doc_id = 92").count() == 6


def test_bad_documents_do_not_stop_the_others(docs):
    got = {r.name: r.status for r in dx.processing_status(docs, F.col("name"), F.col("text")).collect()}
    assert got.pop("empty.txt") == "failed" and got.pop("scan.pdf") == "unsupported"
    assert set(got.values()) == {"processed"}


def test_results_and_reports(docs, lexicon):
    good = docs.where("doc_id < 90")
    key = F.concat(F.lit("uploads/"), F.col("name"))
    result = dx.analysis_rows(good, key, dx.sentiment(good, lexicon, 0.1), dx.key_phrases(good), F.lit("2024-02-01 10:00:00").cast("timestamp"))
    by_name = {r.document: r for r in result.collect()}
    r = by_name["uploads/staff.txt"]
    assert r.extracted_text == TEXTS["staff.txt"] and r.metadata.word_count == len(TEXTS["staff.txt"].split())
    assert ("QUANTITY", "12%") in {(e.type, e.text) for e in r.entities} and len(r.key_phrases) <= 12
    assert sum(r.sentiment.scores) == pytest.approx(1, abs=1e-5)
    report = {x.document: x.report for x in dx.document_report(result).collect()}["uploads/staff.txt"]
    assert "# uploads/staff.txt, read on 2024-02-01T10:00:00" in report and "  - Maria Lopez" in report
    assert f"  positive {r.sentiment.scores.Positive * 100:.1f}%" in report
    quiet = {x.document: x.report for x in dx.document_report(result.withColumns({"entities": F.slice("entities", 1, 0), "key_phrases": F.slice("key_phrases", 1, 0)})).collect()}
    assert quiet["uploads/staff.txt"].count("  (none)") == 2
    totals = dx.corpus_totals(result).first()
    assert totals.documents == 6 and totals.total_words == sum(len(t.split()) for t in TEXTS.values())
    assert totals.most_positive.document == "happy.txt" and totals.most_negative.document == "angry.txt"
    lines = [x.line for x in dx.corpus_report(result).orderBy("section", "position").collect()]
    assert "documents = 6" in lines and "document happy.txt = " + by_name["uploads/happy.txt"].sentiment.overall in lines
    empty = dx.corpus_totals(result.limit(0)).first()
    assert (empty.documents, empty.avg_words) == (0, None)


def test_user_scorer(docs):
    def shout(batches):
        for b in batches:
            yield b.assign(score=b["text"].str.count("!").astype("int64"))[["doc_id", "score"]]

    got = {r.doc_id: r.score for r in dx.score_with(docs, shout, "doc_id bigint, score bigint").collect()}
    assert got[4] == 1 and sum(got.values()) == 1


def test_personal_data(spark):
    text = "mail a.b@c.org, +1 (436) 555-8670 or 10.0.0.1; card 4785380592391139 id 12345678"
    df = spark.createDataFrame([(1, text), (2, "nothing"), (3, None)], "doc_id int, text string")
    got = {r.doc_id: r for r in dx.redact_personal(df).collect()}
    assert got[1].text == "mail [EMAIL], [PHONE] or [ADDRESS]; card [NUMBER] id 12345678"
    assert (got[1].n_email, got[1].n_phone, got[1].n_address, got[1].n_number) == (1, 1, 1, 1)
    assert got[2].text == "nothing" and got[3].text is None and got[3].n_email == 0


LANGUAGES = {"aa": "red green blue one two", "bb": "rot gruen blau eins zwei", "cc": "rouge vert bleu un deux"}


@pytest.fixture(scope="module")
def spoken(spark):
    out = []
    for i in range(90):
        lang = sorted(LANGUAGES)[i % 3]
        parts = LANGUAGES[lang].split()
        out.append((i, " ".join(parts[(i * 7 + k * k) % 5] for k in range(4 + i % 9)), lang))
    return spark.createDataFrame(out, "doc_id int, text string, lang string")


def test_language_guess(spark, spoken):
    profiles = dx.language_profiles(spoken.where("doc_id < 60"))
    got = {r.doc_id: r.guess for r in dx.guess_language(spoken, profiles).collect()}
    assert got == {r.doc_id: r.lang for r in spoken.collect()}
    other = spark.createDataFrame([(1, "unknown words"), (2, ""), (3, None)], "doc_id int, text string")
    assert dx.guess_language(other, profiles).collect() == []


def test_routing(spark, spoken):
    model = dx.fit_router(spoken.where("doc_id < 60"), "lang", features=512)
    held = dx.routed(spoken.where("doc_id >= 60"), model)
    assert held.columns == ["doc_id", "text", "lang", "route"] and held.where("lang <> route").count() == 0
    other = spark.createDataFrame([(1, "", "aa"), (2, None, "bb")], "doc_id int, text string, lang string")
    assert {r.route for r in dx.routed(other, model).collect()} <= set(LANGUAGES)


class Counted:
    """Tables whose texts leave a mark each time they are read."""

    def __init__(self, spark, path):
        @F.udf("string")
        def read(text):
            with open(path, "a") as f:
                f.write("x")
            return text

        texts = [(i, "good day. " * (i % 3) + "bad rain falls" * (i % 2)) for i in range(40)]
        self.spark, self.docs = spark, spark.createDataFrame(texts, "doc_id long, text string").repartition(2).select("doc_id", read("text").alias("text"))
        self.labels = spark.createDataFrame([(i, i % 2) for i in range(0, 40, 3)], "doc_id long, quality int")

    def spread(self, name, key):
        return self.docs


@pytest.mark.parametrize("name", ["document_sentiment", "document_sentiment_shuffled", "sentiment_distribution", "sentiment_trend", "extreme_sentiments", "negative_alerts"])
def test_texts_are_read_once_for_moods(spark, tmp_path, name):
    path = tmp_path / "read"
    plan = getattr(plans, name, None) or getattr(large, name)
    assert plan(Counted(spark, str(path))).count() >= 0
    assert len(path.read_text()) == 40


def test_key_phrases_of_settled_and_other_documents(spark, monkeypatch):
    """Copies, repeated ids, ids that are NULL and ties: the same rows whether frequencies are looked up for a part or for all."""
    words = lambda i, n: " ".join(f"{chr(97 + (i * 7 + j * j) % 26)}{chr(97 + (i + j * 11) % 26)}{chr(97 + j % 13)}" for j in range(n))
    texts = [(i, words(i, 10 * (i % 9))) for i in range(40)] + [(100 + i, words(i, 60)) for i in (3, 3, 5)] + [(200, words(70, 50)), (200, words(71, 50)), (None, words(9, 80)), (300, "zz yy " * 30 + words(80, 60))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    looked = []
    real = dx.lookup_join
    monkeypatch.setattr(dx, "lookup_join", lambda fact, *a, **s: looked.append(fact.count()) or real(fact, *a, **s))
    got = rows(dx.key_phrases(docs, 2, limit=0))
    # Looked up: a part of all, and then all of some documents.
    every = dx.phrase_counts(docs).count()
    assert len(looked) == 2 and looked[0] < every and 0 < looked[1] < every
    assert got == rows(dx.key_phrases(docs, 2)) and len({r[0] for r in got}) > 30


def test_totals_learn_no_moods(spark, tmp_path, monkeypatch):
    def none(*_, **__):
        raise AssertionError("no total needs a lexicon")

    monkeypatch.setattr(dx, "learn_lexicon", none)
    got = plans.corpus_totals(Counted(spark, str(tmp_path / "read"))).first()
    assert (got.documents, got.total_words) == (40, sum(2 * (i % 3) + 3 * (i % 2) for i in range(40)))


def test_texts_are_read_once_for_languages(spark, tmp_path):
    tables, path = Counted(spark, str(tmp_path / "read")), tmp_path / "read"
    tables.docs = tables.docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").when(F.col("doc_id") % 3 == 0, "de"))
    plans.language_guess(tables).collect()
    assert len(path.read_text()) == 40


def test_key_phrases_in_blocks(spark, monkeypatch):
    """Blocks of few terms and many slices give the rows of the plan by text, and store leading phrases only."""
    words = lambda i, n: " ".join(f"{chr(97 + (i * 7 + j * j) % 26)}{chr(97 + (i + j * 11) % 26)}{chr(233 + j % 13)}" for j in range(n))
    texts = [(i, words(i, 10 * (i % 9))) for i in range(40)] + [(100 + i, words(i, 60)) for i in (3, 3, 5)] + [(200, words(70, 50)), (200, words(71, 50)), (None, words(9, 80)), (None, words(9, 80)), (300, "zz yy " * 30 + words(80, 60))]
    docs = spark.createDataFrame([*texts, (400, None), (401, ""), (402, "one"), (403, "A a, a")], "doc_id long, text string").repartition(4)
    stored, real = {}, blocks.written

    def written(df, label):
        out = real(df, label)
        stored[label] = out.count()
        return out

    want = rows(dx.key_phrases(docs, 3))
    monkeypatch.setattr(dx, "PLAIN_CHARACTERS", 0)
    monkeypatch.setattr(dx, "written", written)
    monkeypatch.setattr(blocks, "written", written)
    for terms, bits in ((1 << 19, 8), (100, 2), (1, 0)):
        monkeypatch.setattr(blocks, "BLOCK_TERMS", terms)
        monkeypatch.setattr(blocks, "LEAST_BITS", bits)
        assert rows(dx.key_phrases(docs, 3)) == want
    assert set(stored) == {"blocks", "leading"} and stored["blocks"] > 40
    assert stored["leading"] < 1.5 * 3 * docs.count() < dx.phrase_counts(docs).count()
    none = docs.where("doc_id = 400")
    assert dx.key_phrases(none).count() == 0 and dx.key_phrases(docs.where("doc_id = 403")).count() == 1
    monkeypatch.setattr(dx, "PLAIN_CHARACTERS", -1)
    assert dx.key_phrases(none).count() == 0 and dx.key_phrases(docs.limit(0)).schema == dx.key_phrases(docs).schema


@pytest.mark.parametrize("name", ["key_phrases", "key_phrases_shuffled", "report_phrases", "corpus_totals", "nested_results", "nested_results_flat", "document_reports", "corpus_report"])
def test_queries_store_no_table_of_all_phrases(spark, tmp_path, monkeypatch, name):
    """Phrases of long corpora stay in blocks in every query that uses them; the rows are those of the plan by text."""
    tables = Counted(spark, str(tmp_path / "read"))
    plan = getattr(plans, name, None) or getattr(large, name)
    want, stored = rows(plan(tables)), []
    for module in (dx, blocks):
        monkeypatch.setattr(module, "written", lambda df, label, real=module.written: stored.append(label) or real(df, label))
    monkeypatch.setattr(dx, "PLAIN_CHARACTERS", 0)
    assert rows(plan(tables)) == want
    assert {"blocks", "leading"} <= set(stored) and not {"phrases", "frequencies", "unsettled"} & set(stored)


@pytest.mark.parametrize("limit", [0, 3, 12])
def test_common_terms_are_told_where_they_are_read(spark, monkeypatch, limit):
    """Beyond the limit only the counts of rarer terms are looked up; scores are the same."""
    texts = [(i, " ".join(["so", "so", "and", *(["fine"] * (i % 3)), *(["bad"] * (i % 4)), f"w{'abcdefghijklmnop'[i % 16]}"])) for i in range(60)] + [(70, None), (71, ""), (3, "fine unknown")]
    docs = spark.createDataFrame([*texts, (None, "bad fine")], "doc_id long, text string").repartition(3)
    terms = [("so", 0.1, 60), ("and", 0.0, 60), ("fine", 1.0, 40), ("bad", -1.0, 45), *((f"w{c}", 0.5 if c < "h" else -0.5, 4) for c in "abcdefghijklmnop")]
    lexicon = spark.createDataFrame(terms, "term string, weight double, size long")
    looked, real = [], dx.lookup_join
    want = rows(dx.sentiment(docs, lexicon, 0.25))
    monkeypatch.setattr(dx, "lookup_join", lambda fact, *a, **s: looked.append({r.term for r in fact.select("term").collect()}) or real(fact, *a, **s))
    assert rows(dx.sentiment(docs, lexicon, 0.25, limit=limit)) == want
    known = [t for t, _, _ in sorted(terms, key=lambda x: (-x[2], x[0]))[:limit]]
    assert len(looked) == 1 and not looked[0] & set(known) and {"unknown", "wp"} <= looked[0]
    assert rows(dx.sentiment(docs, lexicon.drop("size"), 0.25, limit=limit)) == want
