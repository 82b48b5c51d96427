import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import substring_dedup
from tests.llm.odd import ROWS, empty, frame, prose, words


def brute(rows, n):
    """Rows of one doc_id are equally early; no doc_id is last."""
    order = lambda i: (i is None, i or 0)
    first, out = {}, []
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - n + 1):
            key = tuple(w[k : k + n])
            first[key] = min(first.get(key, (order(i), k)), (order(i), k))
    for i, t in rows:
        w, gone = words(t), set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < (order(i), k):
                gone |= set(range(k, k + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 4, 20])
def test_equals_brute_force(spark, n):
    got = substring_dedup.remove_repeats(frame(spark), n).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(ROWS, n)


def test_a_passage_in_a_third_of_the_rows(spark):
    passage = prose(99, 60)
    rows = [(i, prose(1000 + i, 40) + (" " + passage + " " if i % 3 == 0 else " ") + prose(2000 + i, 30)) for i in range(300)]
    got = substring_dedup.remove_repeats(frame(spark, rows, 16), 20).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 20)
    assert sum(r.n_removed >= 60 for r in got) == 99


def test_hash_and_empty_table(spark):
    out = substring_dedup.remove_repeats(empty(spark))
    assert out.collect() == [] and out.columns == ["doc_id", "n_words", "n_removed", "kept"]
    row = substring_dedup.remove_repeats(frame(spark, [(1, "b  a\nc")])).select(F.sha2("kept", 256)).first()
    assert row[0] == hashlib.sha256(b"b a c").hexdigest()
