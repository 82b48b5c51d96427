"""Topics by rounds over keyed tables, against a plain version."""

import hashlib
import math
import random

import pytest

from millrace.operators import topics


def corpus(n=60, seed=1):
    """Documents of two themes that share a few words."""
    draw = random.Random(seed)
    themes = [[f"sea{c}" for c in "abcdefgh"], [f"bread{c}" for c in "abcdefgh"]]
    rows = []
    for i in range(n):
        own = themes[i % 2]
        rows.append((i, " ".join(draw.choice(own) if draw.random() < 0.9 else draw.choice(["and", "the", "rare" + chr(97 + i % 26) + chr(97 + i // 26)]) for _ in range(40))))
    return rows + [(900, None), (901, "")]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def plain(rows, k, rounds, alpha=0.1, beta=0.01):
    counts = {i: {w: t.split().count(w) for w in set(t.split())} for i, t in rows if t}
    df = {}
    for c in counts.values():
        for w in c:
            df[w] = df.get(w, 0) + 1
    counts = {i: {w: n for w, n in c.items() if df[w] > 1} for i, c in counts.items()}
    vocabulary = [w for w, n in df.items() if n > 1]
    mass = {w: [1 + int(hashlib.md5(f"42:{i}:{w}".encode()).hexdigest()[:8], 16) / 2**32 for i in range(k)] for w in vocabulary}
    docs, fits = None, []
    for _ in range(rounds):
        total = [sum(mass[w][i] for w in vocabulary) for i in range(k)]
        new_terms, new_docs, fit = {w: [0.0] * k for w in vocabulary}, {}, 0.0
        for d, c in counts.items():
            own = [1 / k] * k if docs is None else [(m + alpha) / (sum(docs[d]) + k * alpha) for m in docs[d]]
            new_docs[d] = [0.0] * k
            for w, n in c.items():
                p = [own[i] * (mass[w][i] + beta) / (total[i] + len(vocabulary) * beta) for i in range(k)]
                fit += n * math.log(sum(p))
                for i in range(k):
                    new_terms[w][i] += n * p[i] / sum(p)
                    new_docs[d][i] += n * p[i] / sum(p)
        mass, docs = new_terms, new_docs
        fits.append(fit)
    return mass, docs, fits


@pytest.mark.parametrize("limit", [200_000, 0])
def test_equals_a_plain_version(spark, limit):
    rows = corpus(24)
    model = topics.begin(table(spark, rows), k=3)
    for _ in range(3):
        model = topics.refine(model, limit)
    mass, docs, fits = plain(rows, 3, 3)
    for kind, want in ((topics.TERM, mass), (topics.DOC, {str(d): m for d, m in docs.items()})):
        got = {r.key: [r.m0, r.m1, r.m2] for r in model.side(kind).collect()}
        assert got.keys() == want.keys()
        assert all(abs(a - b) < 1e-6 for key in got for a, b in zip(got[key], want[key], strict=True))
    assert model.objective == pytest.approx(fits)


def test_objective_rises_and_themes_are_found(spark):
    model, seen = topics.begin(table(spark, corpus()), k=2), []
    for _ in range(8):
        model = topics.refine(model)
        seen.append(topics.objective(model))
    assert all(b >= a - 1e-6 for a, b in zip(seen, seen[1:]))
    leading = {}
    for r in model.leading_terms(6).collect():
        leading.setdefault(r.topic, set()).add(r.term[:3])
    assert sorted(map(sorted, leading.values())) == [["bre"], ["sea"]]
    shares = {int(r.key): r.shares for r in model.of_documents().collect()}
    assert all(max(s) > 0.8 for s in shares.values())
    assert len({shares[i].index(max(shares[i])) for i in range(0, 60, 2)}) == 1


def test_driver_numbers_do_not_follow_the_vocabulary(spark):
    words = [chr(97 + j // 676 % 26) + chr(97 + j // 26 % 26) + chr(97 + j % 26) + "x" * (j // 17576) for j in range(20_000)]
    rows = [(i, " ".join(words[i // 2 * 4000 : i // 2 * 4000 + 4000])) for i in range(10)]
    model = topics.refine(topics.begin(table(spark, rows), k=3))
    assert model.terms == 20_000 and len(model.totals) == 3
    assert sum(model.totals) == pytest.approx(40_000)


def test_leading_terms_query_shape(spark):
    got = topics.topics(table(spark, corpus()), k=2, words=5, rounds=2).collect()
    assert sorted((r.topic, r["rank"]) for r in got) == [(i, j) for i in range(2) for j in range(1, 6)]


def test_no_vocabulary(spark):
    with pytest.raises(ValueError):
        topics.begin(table(spark, [(1, "alone"), (2, None)]))


def test_a_round_shuffles_masses_and_no_counts(spark):
    """Three shuffles: masses to their buckets, to the slices and back. Counts and terms are read where they lie."""
    model = topics.refine(topics.begin(table(spark, corpus()), k=2))
    plan = topics._summed(model)._jdf.queryExecution().executedPlan().toString().split("Final Plan")[-1].split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 3 and "Bucketed: true" in plan


def test_topics_do_not_depend_on_slices(spark):
    """Also with ids that are repeated or missing."""
    rows = corpus(24) + [(3, "seaa seab breada"), (None, "seac rareaa"), (None, "breadb the"), (950, "1 2 3")]
    found = []
    for chars in (topics.SLICE_CHARS, 300):
        model = topics.begin(table(spark, rows), k=3, slice_chars=chars)
        for _ in range(2):
            model = topics.refine(model)
        found.append((model, {(kind, r.key): [r.m0, r.m1, r.m2] for kind in (topics.DOC, topics.TERM) for r in model.side(kind).collect()}))
    (one, a), (two, b) = found
    assert one.packed.select("place").distinct().count() < two.packed.select("place").distinct().count()
    assert a.keys() == b.keys() and (topics.DOC, "") in a and (topics.DOC, "950") not in a
    assert all(abs(x - y) < 1e-6 for key in a for x, y in zip(a[key], b[key], strict=True))
    tokens = {r.key: r.tokens for r in one.of_documents().collect()}
    assert tokens["3"] == pytest.approx(sum(r.n for r in one.cells.where("doc = '3'").join(one.side(topics.TERM).selectExpr("key AS term"), "term").collect()))
