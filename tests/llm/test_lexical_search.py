import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import lexical_search
from tests.llm.odd import LOW, ROWS, empty, frame, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = [(1, prose(1, 12)), (2, "one two, One-TWO!"), (3, None), (4, " ?! "), (5, "naïve 漢字 x"), (6, prose(3, 40) + " w w w"), (2, prose(4, 9)), (None, prose(5, 20)), (7, "unheard")]


def terms(text):
    return [t.translate(LOW) for t in TERM.findall(text or "")]


def brute(rows, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in rows]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, length = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in counts:
            m = 100 - 75 + (75 * n * n_docs) // length
            score = 0
            for t in terms(text):
                if t in c:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def got(docs, items, **more):
    return sorted((tuple(r) for r in lexical_search.search(docs, items, **more).collect()), key=repr)


def items_of(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, i, 1) for i, t in rows], "item_id long, text string, doc long, block int")


def test_equals_brute_force(spark):
    assert got(frame(spark), items_of(spark)) == brute(ROWS, ITEMS)


def test_blocks_and_tiles(spark, monkeypatch):
    for name, value in (("BLOCK_ITEMS", 3), ("DOCUMENTS", 4), ("TERMS", 3), ("MERGES", 2)):
        monkeypatch.setattr(lexical_search, name, value)
    draw = random.Random(3)
    rows = ROWS + [(100 + k, prose(draw.randrange(12), draw.randrange(1, 80))) for k in range(150)]
    assert got(frame(spark, rows), items_of(spark), k=3) == brute(rows, ITEMS, 3)


def test_ties_go_by_doc_id(spark):
    rows = [(k, "same words here") for k in random.Random(1).sample(range(5000), 700)] + [(9000, "other words")]
    found = got(frame(spark, rows, 6), items_of(spark, [(1, "here same"), (2, "words")]))
    assert found == brute(rows, [(1, "here same"), (2, "words")])
    assert [r[2] for r in sorted(found, key=lambda r: r[:2]) if r[0] == 1] == sorted(r[0] for r in rows)[:10]


def test_stretches_stay_exact():
    most, weight = np.array([5, 1, 700, 2]), np.array([10, 3, 20_000, 0])
    exact = 10**11
    stretches = lexical_search.columns(most, weight, 3, exact)
    taken = Counter()
    for terms_, take in stretches:
        assert len(terms_) <= 3 and len(set(terms_)) == len(terms_)
        assert int((take * weight[terms_] * (lexical_search.SCALE // 1000)).sum()) < exact
        taken.update(dict(zip(terms_.tolist(), take.tolist(), strict=True)))
    assert [taken[t] for t in range(4)] == most.tolist()
    assert len(stretches) > 100


def test_repeats_over_several_columns(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "columns", lambda most, weight: columns(most, weight, 2, 3 * 10**9))
    items = [(1, "rare " * 50 + "w1"), (2, "rare w1 w1")]
    rows = [(k, prose(k, 40) + " rare" * (k % 3)) for k in range(40)]
    assert got(frame(spark, rows), items_of(spark, items)) == brute(rows, items)


columns = lexical_search.columns


def test_empty_sides(spark):
    assert got(empty(spark), items_of(spark)) == []
    assert got(frame(spark), items_of(spark).limit(0)) == []
    assert got(frame(spark, [(1, None), (2, " - ")]), items_of(spark)) == []
