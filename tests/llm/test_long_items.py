"""Words, lines and runs that differ far from their beginning are different."""

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import near_dedup, quality, sentencepiece_codec, substring_dedup
from millrace.llm.common import LOWER, Words, text_buffers
from tests.llm.odd import frame, prose, words


def swapped(text, a, b):
    out = list(text)
    out[a], out[b] = out[b], out[a]
    return "".join(out)


def letters(n, seed):
    return "".join(chr(97 + x) for x in np.random.default_rng(seed).integers(0, 26, n))


@pytest.mark.parametrize("distance", [1, 100, 4095, 4096, 4097, 8192, 10_000, 65_536])
def test_words_hash_by_every_place(distance):
    base = "a" * 10 + "b" + letters(distance - 1, 3) + "c" + "d" * 50
    pair = [base, swapped(base, 10, 10 + distance), base]
    one, two, three = Words(*text_buffers(pa.array(pair))).hashes(LOWER)
    assert one == three != two


def test_words_of_two_letters_in_mirrored_patterns():
    pattern = "a"
    for _ in range(12):
        pattern += pattern.translate(str.maketrans("ab", "ba"))
    one, two = Words(*text_buffers(pa.array([pattern, pattern.translate(str.maketrans("ab", "ba"))]))).hashes()
    assert one != two


LONG = letters(5000, 1)
OTHER = swapped(LONG.replace("zz", "zy"), 0, 4096)


def test_line_repeats(spark):
    got = quality.repetition(frame(spark, [(1, LONG + "\n" + OTHER + "\n" + LONG)], 1)).first()
    assert got.n_dup_lines == 1 and got.dup_line_chars == 5000
    got = quality.repetition(frame(spark, [(1, LONG + "\n" + swapped(LONG, 0, 4096))], 1)).first()
    assert got.n_dup_lines == 0 or LONG[0] == LONG[4096]


def test_texts_of_long_words_stay_apart(spark):
    first, second = LONG[1:] + "q", swapped(LONG[1:] + "q", 1, 4097)
    assert first != second
    docs = frame(spark, [(1, first), (2, second), (3, first)])
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_windows_of_long_words_stay_apart(spark):
    body = prose(3, 25).split()
    first, second = LONG[1:] + "q", swapped(LONG[1:] + "q", 1, 4097)
    docs = frame(spark, [(1, " ".join([*body[:10], first, *body[10:19]])), (2, " ".join([*body[:10], second, *body[10:19]]))])
    assert all(r.n_removed == 0 and r.kept.split() == words(t) for r, (_, t) in zip(
        sorted(substring_dedup.remove_repeats(docs).collect(), key=lambda r: r.doc_id),
        [(1, " ".join([*body[:10], first, *body[10:19]])), (2, " ".join([*body[:10], second, *body[10:19]]))], strict=True))


def test_long_runs_have_the_ids_of_the_library():
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=sentencepiece_codec.MODEL_PATH)
    own = sentencepiece_codec.Encoder(sentencepiece_codec.Pieces(sentencepiece_codec.read_model()))
    for seed in range(3):
        text = letters(6000, 10 + seed)
        for t in (text, swapped(text, 3, 4099), swapped(text, 0, 5000)):
            ids, bounds = own.encode([t])
            assert ids.tolist() == library.encode(t)
