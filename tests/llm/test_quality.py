from collections import Counter

from millrace.llm import quality
from tests.llm.odd import ROWS, WORD, empty, frame, prose, words


def covered(w, n):
    grams = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
    count = Counter(grams)
    return {j for k, g in enumerate(grams) if count[g] > 1 for j in range(k, k + n)}


def brute(text):
    text = text or ""
    w, seen, dup, dup_chars = words(text), set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup, dup_chars = dup + 1, dup_chars + sum(map(len, words(line)))
            seen.add(line)
    chars = lambda n: sum(len(w[j]) for j in covered(w, n))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered(w, 3)), dup_chars, chars(5), chars(10))


REPEATS = [
    (20, "a b c\nd e\na b c\n a b c\n\n\na b c"),
    (21, "\n".join([prose(8, 12)] * 9)),
    (22, prose(9, 60) + "\n# & | <b> 100% $5 *\n" + prose(9, 30)),
    (23, "é é é é é é é é é é é é"),
    (24, prose(10, 70).replace(" ", "### ")),
]


def test_counts_equal_brute_force(spark):
    rows = ROWS + REPEATS
    got = quality.repetition(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_verdict(spark):
    judged = {r.doc_id: r for r in quality.judged(quality.repetition(frame(spark, ROWS + REPEATS))).collect() if r.doc_id}
    assert judged[1].kept and judged[9].kept and not judged[1].base_failed
    assert judged[10].base_failed and not judged[10].kept and judged[4].base_failed
    assert not judged[21].kept and not judged[24].kept and not judged[24].base_failed
    assert all(not (r.base_failed and r.kept) for r in judged.values())


def test_empty_table(spark):
    out = quality.judged(quality.repetition(empty(spark)))
    assert out.collect() == [] and {"base_failed", "kept", "dup_chars_10"} <= set(out.columns)
