import math

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from millrace.llm import sentencepiece_codec as codec
from tests.llm.odd import ROWS, empty, frame

EDGES = ["", " ", "  ", "   a", "a   b", "a " * 30, " " * 40 + "x", "▁", "a▁▁b", "\r\n\t", "x\x00y", "\U0001d518ﬁ①", "Hello  world\r\n", "é\xa0x", "▁▁▁", "token=abc", "1234567890" * 20, "ab" * 3000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=codec.MODEL_PATH)


@pytest.fixture(scope="module")
def pieces():
    return codec.Pieces(codec.read_model())


def encode(pieces, texts):
    ids, bounds = codec.Encoder(pieces).encode(texts)
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def test_equals_the_library(library, pieces):
    texts = EDGES + [t for _, t in ROWS if t]
    got = encode(pieces, texts)
    assert got == [library.encode(t) for t in texts]
    ids = np.array([i for g in got for i in g], np.int32)
    bounds = np.append(0, np.cumsum([len(g) for g in got]))
    assert codec.decode(pieces, ids, bounds) == [t.replace("▁", " ") for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_any_text(library, pieces, texts):
    assert encode(pieces, texts) == [library.encode(t) for t in texts]


def test_unigram_search_finds_the_best_sum(pieces):
    """The same search with scores, against all segmentations."""
    names = ["a", "b", "c", "ab", "bc", "abc", "ca", "cab"]
    score = [-2.0, -2.1, -2.2, -3.0, -3.9, -5.5, -3.1, -4.4]
    p = object.__new__(codec.Pieces)
    p.kind, p.longest, p.singles = "unigram", 3, 4
    p.score = np.array([-20.0, *score])
    points = [np.array([ord(c) for c in s], np.uint64) for s in names]
    keys = np.array([codec._hash(x) for x in points], np.uint64)
    p.keys = codec.Probe(codec.mix(keys), np.arange(1, len(names) + 1))
    words = ["abcab", "ccabc", "bbbbb", "cabca", "abzab"]
    number, count = codec.viterbi(p, np.array([[ord(c) for c in w] for w in words], np.uint32))
    at = np.append(0, np.cumsum(count))

    def best(w):
        if not w:
            return 0.0
        options = [score[names.index(w[:k])] + best(w[k:]) for k in range(1, 4) if w[:k] in names]
        return max(options) if options else -20.0 + best(w[1:])

    for w, a, b in zip(words, at, at[1:]):
        total = sum(-20.0 if k < 0 else p.score[k] for k in number[a:b])
        assert math.isclose(total, best(w))
        assert "".join("z" if k < 0 else names[k - 1] for k in number[a:b]) == w


def test_forgetting_changes_nothing(pieces, monkeypatch):
    texts = [t for _, t in ROWS if t]
    want = encode(pieces, texts)
    monkeypatch.setattr(codec, "WORDS_KEPT", 1)
    encoder = codec.Encoder(pieces)
    for t, w in zip(texts, want):
        assert encoder.encode([t])[0].tolist() == w


def test_frames(spark, library):
    model = codec.read_model()
    out = codec.encoded(frame(spark).drop("ids"), model, ["doc_id", "row"])
    assert sorted(((r.doc_id, r.ids) for r in out.collect()), key=repr) == sorted(((i, library.encode(t or "")) for i, t in ROWS), key=repr)
    told = codec.encoded(frame(spark).drop("ids"), model, ["doc_id"], verify=True).collect()
    assert len(told) == len(ROWS) and all(r.round_trip for r in told)
    back = codec.decoded(out, model, ["doc_id"]).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=repr) == sorted(((i, t or "") for i, t in ROWS), key=repr)
    nulls = spark.createDataFrame([(1, None), (2, []), (3, [10**6, -5, None])], "doc_id long, ids array<int>")
    assert [r.text for r in codec.decoded(nulls, model, ["doc_id"]).orderBy("doc_id").collect()][:2] == ["", ""]
    assert codec.encoded(empty(spark).drop("ids"), model, ["doc_id"]).collect() == []
