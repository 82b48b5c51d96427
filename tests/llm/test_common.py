import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from millrace.llm.common import LOWER, Words, ngram_hashes, ranges_to_bytes, runs, shingle_rows, sliding_min, slices, text_buffers
from tests.llm.odd import LOW, words

TEXT = st.text(alphabet=st.sampled_from(list(" \t\n\x0b\x1cabAB  éß漢\U0001f600")), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_and_hashes(texts):
    data, offsets = text_buffers(pa.array(texts, pa.string()))
    w = Words(data, offsets)
    got = [[data[w.start[i] : w.end[i]].tobytes().decode() for i in range(w.bounds[r], w.bounds[r + 1])] for r in range(len(texts))]
    want = [words(t) for t in texts]
    assert got == want
    flat = [x.translate(LOW) for t in want for x in t]
    hashes = w.hashes(LOWER).tolist()
    assert len(set(flat)) == len(set(hashes)) and len(dict(zip(flat, hashes))) == len(set(zip(flat, hashes)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 21))
def test_windows(values, n):
    hashes = ngram_hashes(np.array(values, np.uint64), n).tolist()
    grams = [tuple(values[i : i + n]) for i in range(len(values) - n + 1)]
    assert len(hashes) == len(grams)
    assert len(set(grams)) == len(set(hashes)) == len(set(zip(grams, hashes)))
    if len(values) >= n:
        assert sliding_min(np.array(values), n).tolist() == [min(g) for g in grams]


def test_shingles_of_short_texts():
    texts = ["a b", "a b c d e", "", "a  B", "a b c d e f"]
    data, offsets = text_buffers(pa.array(texts))
    w = Words(data, offsets)
    value, row = shingle_rows(w, w.hashes(LOWER), 5)
    per = [set(value[row == r].tolist()) for r in range(len(texts))]
    assert [len(p) for p in per] == [1, 1, 0, 1, 2]
    assert per[0] == per[3] and per[1] < per[4]


def test_small_helpers():
    assert ranges_to_bytes(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert [x.tolist() for x in runs(np.array([True, False, True, True]))] == [[0, 2, 3], [2, 1, 1]]
    offsets = np.array([0, 5, 5, 30, 31, 40])
    parts = list(slices(offsets, 10))
    assert parts[0][0] == 0 and parts[-1][1] == 5 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert list(slices(np.array([0]))) == []
