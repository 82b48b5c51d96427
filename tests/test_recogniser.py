"""The trained recogniser: best paths against all paths, and names in context that it has not seen."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import recogniser


@pytest.mark.parametrize("seed", range(5))
def test_best_paths_equal_all_paths(seed):
    rng = np.random.default_rng(seed)
    scores, moves = rng.normal(size=(4, 5, 3)), rng.normal(size=(4, 3))
    tags, margins = recogniser.best_paths(scores, moves)

    def value(s, path):
        return s[0, path[0]] + moves[3, path[0]] + sum(moves[a, b] + s[i + 1, b] for i, (a, b) in enumerate(zip(path, path[1:])))

    for s, got, margin in zip(scores, tags, margins, strict=True):
        every = {p: value(s, p) for p in itertools.product(range(3), repeat=5)}
        best = max(every, key=every.get)
        assert tuple(got) == best
        for i in range(5):
            other = max(v for p, v in every.items() if p[i] != best[i])
            assert margin[i] == pytest.approx(every[best] - other)


def test_tokens_cover_the_text():
    text = "Dr. Ann Lee paid $5. She left!  Naïve 漢字_x " + "word " * 300
    cut = recogniser.sequences(text)
    assert "".join(text[a:b] for s in cut for a, b in s) == "".join(text.split())
    assert max(map(len, cut)) <= recogniser.LONGEST and recogniser.sequences("") == []


def test_gold_tags():
    text = "Ann Lee met Ann. Leeward"
    places = [p for s in recogniser.sequences(text) for p in s]
    tags = recogniser.gold_tags(text, places, [("P", "Ann Lee"), ("P", "Ann"), ("Q", "Lee")], ["", "P", "Q"])
    assert tags.tolist() == [1, 1, 0, 1, 0, 0]


def sentences(seed, names, n):
    draw = random.Random(seed)
    fill = ["the market fell", "prices rose again", "a bridge was built", "it rained all day", "trains ran late"]
    rows = []
    for i in range(n):
        name, place = draw.choice(names), draw.choice(["Paris", "Oslo", "Lima"])
        text = draw.choice([f"yesterday {name} said that {draw.choice(fill)}.", f"{draw.choice(fill)} in {place}, {name} told us.", f"we asked {name} why {draw.choice(fill)} near {place}."])
        rows.append((i, text, [("PERSON", name)] + ([("LOCATION", place)] if place in text else [])))
    return rows + [(n, None, []), (n + 1, "", []), (n + 2, "nothing here.", [])]


SCHEMA = "doc_id long, text string, hits array<struct<type:string,text:string>>"


def invented(seed, n):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("bdfgklmnprstv") + draw.choice("aeiou") for _ in range(draw.choice([2, 3]))).capitalize()
    return [f"{word()} {word()}" for _ in range(n)]


def test_unseen_names_in_context(spark):
    known, unseen = invented(1, 80), invented(2, 40)
    assert not set(known) & set(unseen)
    model = recogniser.fit(spark.createDataFrame(sentences(1, known, 300), SCHEMA).repartition(3))
    test = sentences(2, unseen, 150)
    got = {(r.doc_id, r.type, r.text) for r in recogniser.recognised(spark.createDataFrame(test, SCHEMA), model).collect()}
    want = {(i, *h) for i, _, hits in test for h in hits}
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.9 * len(got)
    scores = [r.score for r in recogniser.recognised(spark.createDataFrame(test, SCHEMA), model).collect()]
    assert all(0.5 <= s <= 1 for s in scores)


def test_no_hits_and_no_texts(spark):
    model = recogniser.fit(spark.createDataFrame([(1, "some words.", [])], SCHEMA), rounds=1)
    assert model.tags == [""] and recogniser.recognised(spark.createDataFrame([(1, "Ann Lee.", [])], SCHEMA), model).collect() == []
    assert recogniser.fit(spark.createDataFrame([], SCHEMA)).tags == [""]


def test_paths_of_all_sizes_together():
    """Sequences laid end to end get the paths and margins that each gets alone."""
    rng = np.random.default_rng(7)
    size, moves = np.array([3, 1, 6, 6, 2]), rng.normal(size=(4, 3))
    scores = rng.integers(0, 3, (18, 3)).astype(float)
    tags, margins = recogniser.ragged_paths(scores, size, moves)
    ends = np.cumsum(size)
    alone = [recogniser.best_paths(scores[None, b - n : b], moves) for n, b in zip(size, ends, strict=True)]
    assert tags.tolist() == np.concatenate([t[0] for t, _ in alone]).tolist()
    assert np.allclose(margins, np.concatenate([m[0] for _, m in alone]))


def test_texts_are_tokenised_once(spark, tmp_path):
    """Rounds read the written steps, not the texts."""
    calls = str(tmp_path / "calls")

    @F.udf("string")
    def read(text):
        with open(calls, "a") as f:
            f.write("x")
        return text

    docs = spark.createDataFrame(sentences(1, invented(1, 20), 40), SCHEMA).withColumn("text", read("text"))
    assert len(recogniser.fit(docs, rounds=3).tags) == 3
    with open(calls) as f:
        assert len(f.read()) <= 2 * 43


def odd_texts():
    draw = random.Random(5)
    parts = ["Dr. Ann Lee", "paid", "$5.", "She left!", "U.S.", "Naïve 漢字_x", "it?", "A.", "B!", "...", "12.5%", "word " * 130, "no end " * 61, "<", ">"]
    return [None, "", "!", "Mr.", *(" ".join(draw.choice(parts) for _ in range(draw.randrange(1, 30))) for _ in range(60))]


def test_texts_are_cut_at_once():
    """Sequences of a whole text, their known tags, and the features of many are those that each gets alone."""
    hits = [("P", "Ann Lee"), ("P", "Ann"), ("Q", "5"), ("Q", "12"), ("R", "left!"), ("R", "x it"), ("R", "word word")]
    kinds, known, seen = ["", "P", "Q", "R"], recogniser._by_first_token(hits), recogniser._Seen()
    for text in odd_texts():
        text = text or ""
        one = recogniser.sequences(text)
        places, tokens, sizes = recogniser.cut(text)
        assert sizes == [len(x) for x in one] and places == [p for x in one for p in x] and tokens == [text[a:b] for a, b in places]
        assert recogniser._gold_of_all(text, places, tokens, sizes, known, kinds).tolist() == [t for x in one for t in recogniser.gold_tags(text, x, hits, kinds)]
        alone = [recogniser.token_features([text[a:b] for a, b in x]) for x in one]
        assert recogniser.sequence_features(tokens, np.array(sizes, int), seen).tolist() == [f for x in alone for f in x.tolist()]


def test_right_steps_are_tagged_together(monkeypatch):
    """The weights are those of one step after the other, with far fewer searches for paths."""
    texts = odd_texts() * 12
    hits = [[{"type": k, "text": p} for k, p in (("P", "Ann Lee"), ("Q", "12.5%"), ("R", "left!")) if p in (t or "")] for t in texts]
    batch = recogniser.pa.table({"text": texts, "hits": hits}).to_batches()
    monkeypatch.setattr(recogniser, "AT_ONCE", 500)
    rows = [r for b in recogniser._steps(iter(batch)) for r in b.to_pylist()]
    steps = []
    for r in rows:
        size = np.frombuffer(r["sizes"], np.uint8).astype(np.int64)
        assert len(size) == recogniser.STEP or r is rows[-1]
        steps.append((np.frombuffer(r["features"], np.uint16).reshape(int(size.sum()), -1), size, np.array([["", "P", "Q", "R"].index(k) for k in r["kinds"]])[np.frombuffer(r["gold"], np.uint8)]))
    assert sum(int(s.sum()) for _, s, _ in steps) == sum(len(x) for t in texts for x in recogniser.sequences(t or ""))
    one, all_ = (recogniser._Learner(recogniser.Recogniser.blank("PQR")) for _ in range(2))
    for features, size, gold in steps * 3:
        one.learn(features, size, gold)
    calls, real = [], recogniser.tagged
    monkeypatch.setattr(recogniser, "tagged", lambda *a, **b: calls.append(1) or real(*a, **b))
    all_.learn_all(steps * 3)
    assert one.steps == all_.steps == 3 * len(steps) and (one.mean() == all_.mean()).all() and one.mean().any()
    assert len(calls) < len(steps)
