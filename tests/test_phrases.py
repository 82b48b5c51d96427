"""Phrases of any length against counts of all runs."""

import random
from collections import Counter

import pytest

from millrace.operators import phrases


def corpus(seed=1, n=80):
    draw = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa"]
    rows = []
    for i in range(n):
        text = [draw.choice(words) for _ in range(30)]
        if i % 2 == 0:
            at = draw.randrange(30)
            text[at:at] = ["new", "york", "stock", "exchange"]
        rows.append((i, " ".join(text)))
    return rows + [(900, None), (901, ""), (902, "alpha"), (902, "alpha beta")]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def brute(rows, least, longest):
    count = Counter()
    for _, t in rows:
        w = (t or "").split()
        for length in range(2, longest + 1):
            count.update(" ".join(w[k : k + length]) for k in range(len(w) - length + 1))
    return {p: n for p, n in count.items() if n >= least}


@pytest.mark.parametrize("limit", [200_000, 0])
def test_counts_equal_brute_force(spark, limit):
    rows = corpus()
    found, places = phrases.mined(table(spark, rows), least=8, longest=6, limit=limit)
    assert {r.phrase: r.n for r in found.collect()} == brute(rows, 8, 6)
    per = Counter()
    for r in places.collect():
        per[r.phrase] += r.n
    assert per == brute(rows, 8, 6)


def test_significance(spark):
    rows = corpus()
    words = Counter(w for _, t in rows for w in (t or "").split())
    total, runs = sum(words.values()), {**words, **brute(rows, 8, 6)}
    found, _ = phrases.mined(table(spark, rows), least=8, longest=6)
    for r in found.collect():
        begin, last = r.phrase.rsplit(" ", 1)
        assert r.significance == pytest.approx((r.n - runs[begin] * words[last] / total) / r.n**0.5, abs=1e-5)


def test_a_planted_phrase_comes_out_whole(spark):
    found, _ = phrases.mined(table(spark, corpus()), least=8)
    kept = {r.phrase for r in phrases.whole(found).collect()}
    assert "new york stock exchange" in kept
    assert not kept & {"new york", "york stock", "stock exchange", "new york stock", "york stock exchange"}
    leading = {r.doc_id: r.phrase for r in phrases.leading_phrases(table(spark, corpus()), k=1, least=8).collect()}
    assert sum(leading.get(i) == "new york stock exchange" for i in range(0, 80, 2)) > 30


def test_nothing_is_frequent(spark):
    found, places = phrases.mined(table(spark, [(1, "a b c"), (2, None)]), least=2)
    assert found.collect() == [] and places.collect() == []


def test_hashes_decide_nothing(spark, monkeypatch):
    """Runs that share a hash and a bitmap that lets all pass: the same counts."""
    rows = corpus(n=30)
    monkeypatch.setattr(phrases, "_FACTOR", phrases.np.uint64(0))
    monkeypatch.setattr(phrases, "LEAST_BITS", 64)
    monkeypatch.setattr(phrases, "MOST_BITS", 64)
    found, places = phrases.mined(table(spark, rows), least=5, longest=3)
    assert {r.phrase: r.n for r in found.collect()} == brute(rows, 5, 3)
    placed = places.collect()
    assert sum(r.n for r in placed) == sum(brute(rows, 5, 3).values())
    assert len({(r.doc_id, r.phrase) for r in placed if r.doc_id != 902}) == sum(r.doc_id != 902 for r in placed)


def test_places_are_not_shuffled(spark):
    """A round sends runs with their counts, added up before: few rows for many places."""
    docs = table(spark, [(i, "one two three four " * 50) for i in range(40)]).coalesce(1)
    live = phrases._hashed(docs.select(phrases.tx.terms(phrases.F.col("text")).alias("terms")))
    sent = live.mapInArrow(phrases._counted(2), "phrase string, n long").collect()
    assert sorted((r.phrase, r.n) for r in sent) == [("four one", 1960), ("one two", 2000), ("three four", 2000), ("two three", 2000)]


def test_long_batches_are_counted_in_pieces(spark, monkeypatch):
    """A task counts so many terms at once, however long the texts of a batch are; sums and places are the same."""
    seen, real = [], phrases._flat
    monkeypatch.setattr(phrases, "_flat", lambda batch: seen.append(len(batch["terms"].flatten())) or real(batch))
    monkeypatch.setattr(phrases, "PIECE_TERMS", 70)
    docs = [["alpha", "beta", "gamma"] * 10] * 9 + [[], ["alpha"], ["beta"] * 200]
    table_ = phrases.pa.table({"doc_id": list(range(12)), "terms": docs, "hashes": [[hash(w) for w in d] for d in docs]})
    out = Counter()
    for batch in phrases._counted(2)(iter(table_.to_batches())):
        for phrase, n in zip(batch["phrase"].to_pylist(), batch["n"].to_pylist(), strict=True):
            out[phrase] += n
    assert out == {"alpha beta": 90, "beta gamma": 90, "gamma alpha": 81, "beta beta": 199}
    assert max(seen) == 200 and sorted(seen)[-2] <= 70
    placed = [r for b in phrases._counted(2, doc="doc_id")(iter(table_.to_batches())) for r in b.to_pylist()]
    assert len(placed) == 28 and {r["n"] for r in placed if r["doc_id"] == 4} == {9, 10}
    assert {r.phrase: r.n for r in phrases.mined(table(spark, corpus()), least=8)[0].collect()} == brute(corpus(), 8, 6)
