"""SentencePiece encoding and decoding with a batched Viterbi search.

A text is cut between any two characters that are neighbours in no piece, so that no piece
crosses a cut: before blanks, mostly before punctuation, around unknown characters. The
different words of a batch are searched together: words of equal length advance
position by position in one numpy step. At a position, the hashes of all substrings that
end there probe the sorted hashes of the pieces, and the best extension is kept as a back-pointer.

* unigram models: the best sum of piece scores, as usual.
* BPE models: of the pieces that end at a position exactly one continues the encoding of
  the prefix before it, namely the one that forms a valid pair with that prefix's last piece
  (no merge of the two, or of their parts, would have come first). The search takes the
  longest valid one; the path is then the sequence of merges' result, id for id.

Characters outside the model become byte pieces, or the unknown piece where the model has none.
Runs of blanks use the model's pieces of blanks from the left, longest first, after all other merges.
The model file stays outside the repository; its bytes are broadcast (limited to `MODEL_BYTES`).

Defined results: null and empty texts have no ids and decode to the empty text; decoding drops
the blank that encoding puts in front; bytes that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import mix, place_values, ranges_to_bytes, runs, share, slices, text_buffers

BLANK = "▁"
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_BYTES = 64 << 20
WORDS_KEPT, WORDS_AT_ONCE = 200_000, 8192
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_NONE, _FAR = -1, 1 << 40


class Probe:
    """Sorted 64-bit keys, found by an index of their leading bits and a comparison."""

    BITS = 20

    def __init__(self, key: np.ndarray, value: np.ndarray):
        order = np.argsort(key)
        self.key, self.value = key[order], value[order]
        self.first = np.searchsorted(self.key >> np.uint64(64 - self.BITS), np.arange(2**self.BITS + 1, dtype=np.uint64))
        self.most = int(np.diff(self.first).max())

    def find(self, key: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        flat = key.reshape(-1)
        lead = (flat >> np.uint64(64 - self.BITS)).astype(np.intp)
        at = self.first.take(lead)
        last = self.first.take(lead + 1)
        out = np.full(len(flat), _NONE, np.int64)
        some = np.flatnonzero(at < last)
        for _ in range(self.most):
            place = at[some]
            hit = self.key.take(place) == flat[some]
            out[some[hit]] = self.value.take(place[hit])
            at[some] += 1
            some = some[~hit & (place + 1 < last[some])]
            if not len(some):
                break
        return out.reshape(key.shape)


class Pieces:
    """Tables of a model. Pieces have inner numbers: 0 unknown, then single characters, then
    longer pieces by rank."""

    def __init__(self, data: bytes, kind: str | None = None):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        text, score = {i: sp.id_to_piece(i) for i in normal}, {i: sp.get_score(i) for i in normal}
        self.unknown, self.bytes = sp.unk_id(), np.full(256, sp.unk_id(), np.int32)
        self.raw = [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[1:-1], 16)
                self.bytes[value], self.raw[i] = i, bytes([value])
            elif i in text:
                self.raw[i] = text[i].replace(BLANK, " ").encode()
            elif sp.is_unknown(i):
                self.raw[i] = " ⁇ ".encode()
        self.has_bytes = any(sp.is_byte(i) for i in range(n))
        blanks = {len(text[i]): i for i in normal if set(text[i]) == {BLANK}}
        singles = sorted((i for i in normal if len(text[i]) == 1), key=lambda i: text[i])
        longer = sorted((i for i in normal if len(text[i]) > 1 and len(text[i]) not in (blanks if set(text[i]) == {BLANK} else ())), key=lambda i: -score[i])
        if any(BLANK in text[i].lstrip(BLANK) for i in normal):
            raise ValueError("pieces that cross a blank are not supported")
        ranks = [score[i] for i in longer]  # whole numbers in a BPE model, log probabilities in a unigram model
        self.kind = kind or ("bpe" if len(set(ranks)) == len(ranks) and all(r == int(r) for r in ranks) else "unigram")
        self.ids = np.array([self.unknown, *singles, *longer], np.int32)
        names = ["", *[text[i] for i in (*singles, *longer)]]
        self.score = np.array([min(score.values()) - 10, *[score[i] for i in (*singles, *longer)]])
        self.singles, self.longest = len(singles) + 1, max(map(len, names))
        number = {s: k for k, s in enumerate(names)}
        self.blank = number.get(BLANK, 0)
        self.blanks = np.array([blanks.get(k, _NONE) for k in range(max(blanks, default=0) + 1)], np.int32)
        reach = np.ones(len(names), bool)
        reach[0] = False
        self.left, self.right = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        if self.kind == "bpe":
            for k in range(self.singles, len(names)):
                parts = _merged(names[k], number, k)
                if len(parts) == 2:
                    self.left[k], self.right[k] = number[parts[0]], number[parts[1]]
                else:
                    reach[k] = False
            whole = np.flatnonzero(reach)
            whole = whole[whole >= self.singles]
            self.pairs = Probe(_pair_key(self.left[whole], self.right[whole]), whole)
        points = [np.array([ord(c) for c in s], np.uint64) for s in names]
        keys = np.array([_hash(p) for p in points], np.uint64)
        found = np.flatnonzero(reach)
        if len(np.unique(keys[found])) != len(found):
            raise ValueError("two pieces share a hash")
        self.keys = Probe(mix(keys[found]), found)
        # Class of each character, and which classes are neighbours in a piece.
        self.of = np.zeros(0x110000, np.uint16)
        self.of[[ord(names[k]) for k in range(1, self.singles)]] = np.arange(1, self.singles)
        self.near = np.zeros((self.singles, self.singles), bool)
        for k in found[found >= self.singles].tolist():
            c = self.of[points[k].astype(np.int64)]
            self.near[c[:-1], c[1:]] = True
        self.symbol = mix(np.arange(self.singles, dtype=np.uint64) + np.uint64(1))

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the encoding of a pair's text is the pair itself."""
        ok = np.ones(len(left), bool)
        todo, a, b, limit = np.arange(len(left)), left.copy(), right.copy(), np.full(len(left), _FAR)
        while len(todo):
            merged = self.pairs.find(_pair_key(a, b))
            early = (merged >= 0) & (merged < limit)
            ok[todo[early]] = False
            go = ~early & ((a >= self.singles) | (b >= self.singles))
            todo, a, b = todo[go], a[go], b[go]
            from_left = a > b
            limit = np.where(from_left, a, b + 1)
            a, b = np.where(from_left, self.right.take(a), a), np.where(from_left, b, self.left.take(b))
        return ok


def _pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix((left << 32 | right).astype(np.uint64))


def _merged(text: str, number: dict[str, int], below: int) -> list[str]:
    """The parts of a text after all merges into pieces numbered less than `below`."""
    parts = list(text)
    while len(parts) > 1:
        rank, at = min((number.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def _hash(points: np.ndarray) -> np.uint64:
    value = 0
    for v in mix(points + np.uint64(1)).tolist():
        value = (value * int(_BASE) + v) % 2**64
    return np.uint64(value)


def viterbi(pieces: Pieces, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner piece numbers of words of equal length (n x length code points), word after word,
    and their number per word. An unknown character c is -c - 1."""
    n, length = points.shape
    item = mix(points.astype(np.uint64) + np.uint64(1))
    prefix = np.zeros((n, length + 1), np.uint64)
    for i in range(length):
        prefix[:, i + 1] = prefix[:, i] * _BASE + item[:, i]
    power = np.cumprod(np.full(pieces.longest, _BASE))
    last = np.zeros((n, length + 1), np.int64)
    back = np.ones((n, length + 1), np.int32)
    total = np.zeros((n, length + 1))
    every = np.arange(n)
    for i in range(1, length + 1):
        most = min(i, pieces.longest)
        start = prefix[:, i - most : i][:, ::-1]  # column k - 1: the substring of k characters
        piece = pieces.keys.find(mix(prefix[:, i : i + 1] - start * power[:most]))
        piece[:, 0] = np.maximum(piece[:, 0], 0)
        if pieces.kind == "unigram":
            value = np.where(piece >= 0, total[:, i - most : i][:, ::-1] + pieces.score[piece], -np.inf)
        else:
            value = piece >= 0
            undecided = np.ones(n, bool)
            for k in range(most, 0, -1):  # the longest valid piece; once found, shorter ones need no test
                value[:, k - 1] &= undecided
                rows = np.flatnonzero(value[:, k - 1])
                if k < i and len(rows):
                    value[rows, k - 1] = pieces.compatible(last[rows, i - k], piece[rows, k - 1])
                undecided &= ~value[:, k - 1]
        best = value.argmax(axis=1)
        last[:, i], back[:, i] = piece[every, best], best + 1
        if pieces.kind == "unigram":
            total[:, i] = value[every, best]
    number, at = np.zeros((n, length), np.int64), np.full(n, length)
    count = np.zeros(n, np.int64)
    active = every
    while len(active):
        here = last[active, at[active]]
        unknown = here == 0
        here[unknown] = -points[active[unknown], at[active[unknown]] - 1].astype(np.int64) - 1
        count[active] += 1
        number[active, length - count[active]] = here
        at[active] -= back[active, at[active]]
        active = active[at[active] > 0]
    return number[np.arange(length) >= (length - count)[:, None]], count


class Encoder:
    """Encodes texts; keeps the words it has seen, up to a limit."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        """Words by hash (sorted), and their ids."""
        self.seen, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and the offsets of the texts."""
        points = np.frombuffer("".join(BLANK + t for t in texts if t).replace(" ", BLANK).encode("utf-32-le"), np.uint32)
        bounds = np.append(0, np.cumsum([len(t) + 1 if t else 0 for t in texts]))
        if not len(points):
            return np.zeros(0, np.int32), bounds
        kind = self.pieces.of.take(points)
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.pieces.near[kind[:-1], kind[1:]]
        cut[bounds[:-1][bounds[:-1] < len(points)]] = True
        start, size = runs(cut)
        item = self.pieces.symbol.take(kind)
        strange = np.flatnonzero(kind == 0)
        item[strange] = mix(points[strange].astype(np.uint64) + np.uint64(1 << 32))
        item *= place_values(np.arange(len(points)) - np.repeat(start, size))
        word, first, which = np.unique(mix(np.add.reduceat(item, start)), return_index=True, return_inverse=True)
        if len(self.seen) > WORDS_KEPT:
            self._forget()
        at = np.searchsorted(self.seen, word)
        new = np.flatnonzero(self.seen.take(at, mode="clip") != word) if len(self.seen) else np.arange(len(word))
        if len(new):
            self._learn(word[new], points, start[first[new]], size[first[new]])
            at = np.searchsorted(self.seen, word)
        index = self.place[at][which]
        count = self.size[index]
        words = np.searchsorted(start, bounds)
        return self._joined_blanks(self.flat[ranges_to_bytes(self.start[index], count)], np.append(0, np.cumsum(count))[words])

    def _learn(self, word: np.ndarray, points: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Search the words at these places of `points`."""
        parts, counts, order = [], [], np.argsort(size, kind="stable")
        for a, n in zip(*runs(np.append(True, np.diff(size[order]) != 0)), strict=True):
            length = int(size[order[a]])
            step = max(1, min(WORDS_AT_ONCE, (1 << 20) // length))
            for k in range(a, a + n, step):
                some = order[k : min(k + step, a + n)]
                ids, count = self._ids(*viterbi(self.pieces, points[start[some][:, None] + np.arange(length)]))
                parts.append(ids)
                counts.append(count)
        count, old = np.concatenate(counts), len(self.size)
        self.start = np.append(self.start, len(self.flat) + np.cumsum(count) - count)
        self.size = np.append(self.size, count)
        self.flat = np.concatenate([self.flat, *parts])
        seen, place = np.append(self.seen, word[order]), np.append(self.place, old + np.arange(len(order)))
        by = np.argsort(seen)
        self.seen, self.place = seen[by], place[by]

    def _ids(self, number: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Model ids of inner numbers; an unknown character becomes its bytes."""
        p = self.pieces
        ids = p.ids[np.maximum(number, 0)]
        strange = np.flatnonzero(number < 0)
        if len(strange) and p.has_bytes:
            width = np.ones(len(number), np.int64)
            points, which = np.unique(-number[strange] - 1, return_inverse=True)
            spelled = [p.bytes[np.frombuffer(chr(c).encode(), np.uint8)] for c in points.tolist()]
            width[strange] = np.array([len(s) for s in spelled])[which]
            owner = np.repeat(np.arange(len(count)), count)
            out = np.repeat(ids, width)
            begin = (np.cumsum(width) - width)[strange]
            for k, s in enumerate(spelled):
                for j, one in enumerate(s):
                    out[begin[which == k] + j] = one
            return out, np.bincount(owner, weights=width, minlength=len(count)).astype(np.int64)
        return ids, count

    def _joined_blanks(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of blank pieces become the pieces of several blanks."""
        p, most = self.pieces, len(self.pieces.blanks) - 1
        blank = p.ids[p.blank] if p.blank else _NONE
        if most < 2 or not len(ids):
            return ids, bounds
        mine = ids == blank
        first = mine.copy()
        first[1:] &= ~mine[:-1]
        first[bounds[:-1][bounds[:-1] < len(ids)]] = mine[bounds[:-1][bounds[:-1] < len(ids)]]
        at = np.flatnonzero(first)
        run = np.add.reduceat(mine.astype(np.int64), at) if len(at) else at
        keep = np.ones(len(ids), bool)
        out = ids.copy()
        for a, n in zip(at[run > 1].tolist(), run[run > 1].tolist(), strict=True):
            keep[a : a + n] = False
            while n:
                size = next(k for k in range(min(n, most), 0, -1) if k == 1 or p.blanks[k] != _NONE)
                keep[a], out[a] = True, blank if size == 1 else p.blanks[size]
                a, n = a + size, n - size
        return out[keep], np.append(0, np.cumsum(keep))[bounds]


def decode(pieces: Pieces, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Texts of the ids, text after text."""
    raw = np.frombuffer(b"".join(pieces.raw), np.uint8)
    size = np.array([len(r) for r in pieces.raw], np.int64)
    start = np.cumsum(size) - size
    ids = np.where((ids >= 0) & (ids < len(size)), ids, pieces.unknown)
    data = raw[ranges_to_bytes(start[ids], size[ids])].tobytes()
    at = np.append(0, np.cumsum(size[ids]))[bounds].tolist()
    return [data[a + (data[a : a + 1] == b" ") : b].decode("utf-8", "replace") for a, b in zip(at, at[1:], strict=False)]


def read_model(path: str = MODEL_PATH) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MODEL_BYTES + 1)
    if len(data) > MODEL_BYTES:
        raise ValueError("the model is larger than MODEL_BYTES")
    return data


def _kept(df: DataFrame, keep: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)


def encoded(docs: DataFrame, model: bytes, keep: list[str], text_col: str = "text", verify: bool = False) -> DataFrame:
    """The columns `keep` and `ids`, the piece ids of each whole text; with `verify` also `round_trip`,
    whether the ids decode to the text (its U+2581 read as blanks, as the model does)."""
    pieces = share(docs.sparkSession, Pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces())
        for batch in batches:
            texts = batch["_text"]
            _, offsets = text_buffers(texts)
            for a, b in slices(offsets):
                ids, bounds = encoder.encode(texts.slice(a, b - a).to_pylist())
                out = [*[batch[c].slice(a, b - a) for c in keep], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
                if verify:
                    back = decode(encoder.pieces, ids, bounds)
                    out.append(pa.array([x == (t or "").replace(BLANK, " ") for x, t in zip(back, texts.slice(a, b - a).to_pylist(), strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(out, names)

    rows, names = docs.select(*keep, F.col(text_col).alias("_text")), [*keep, "ids", *["round_trip"] * verify]
    return rows.mapInArrow(run, f"{_kept(docs, keep)}, ids array<int>" + ", round_trip boolean" * verify)


def decoded(df: DataFrame, model: bytes, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """The columns `keep` and `text`, decoded from the ids; null ids decode to the empty text."""
    pieces = share(df.sparkSession, Pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces()
        for batch in batches:
            ids = batch["_ids"]
            size = np.array([len(x) if x.is_valid else 0 for x in ids], np.int64) if ids.null_count else np.diff(ids.offsets.to_numpy())
            values = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            texts = decode(own, values, np.append(0, np.cumsum(size)))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], pa.array(texts, pa.string())], [*keep, "text"])

    rows = df.select(*keep, F.col(ids_col).alias("_ids"))
    return rows.mapInArrow(run, f"{_kept(df, keep)}, text string")


def query(spark, sf_dir: str, path: str = MODEL_PATH) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = encoded(docs, read_model(path), ["doc_id"], verify=True)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")
