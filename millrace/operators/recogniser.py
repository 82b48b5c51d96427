"""A trained recogniser of entities: averaged structured perceptron over token features.

A text is cut into tokens and these into sequences at sentence ends; nothing is left out. Every token has one of the tags
`NONE` and the entity types; a sequence is tagged by the best path over token scores and tag transitions (Viterbi), all
sequences of one length side by side in numpy.

Learning runs in rounds over all training texts. Every partition starts from the same weights, corrects them
where the best path is wrong, and returns their mean over its steps; the mean over partitions, by tokens, is where the
next round starts. The weights have a fixed number of hashed features, which is what the driver holds.

The score of an entity comes from its margin: by how much the best path loses if any of its tokens gets another tag.
"""

from __future__ import annotations

import bisect
import itertools
import pickle
import re
import sys
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NONE = ""
FEATURES, LONGEST, TOGETHER, STEP, MOST_SEEN = 1 << 16, 120, 256, 32, 1 << 17
# Tokens whose features are made at once, and steps that are tagged together.
AT_ONCE, MOST_STEPS = 1 << 16, 64
TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
ENDS = frozenset(".!?")


@dataclass
class Recogniser:
    """Weights of features (FEATURES x tags) and of transitions (before x after; the last row begins a sequence)."""

    tags: list[str]
    features: np.ndarray
    moves: np.ndarray

    @classmethod
    def blank(cls, types: Sequence[str]) -> Recogniser:
        tags = [NONE, *sorted(set(types))]
        return cls(tags, np.zeros((FEATURES, len(tags))), np.zeros((len(tags) + 1, len(tags))))


# ---------------------------------------------------------------- tokens


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """Places of the tokens of each sequence: up to a sentence end, or `LONGEST` tokens."""
    out: list[list[tuple[int, int]]] = []
    own: list[tuple[int, int]] = []
    for m in TOKEN.finditer(text):
        own.append(m.span())
        if m.group() in ENDS and not (len(own) > 1 and own[-2][1] - own[-2][0] <= 3 and text[own[-2][0]].isupper()) or len(own) == LONGEST:
            out.append(own)
            own = []
    return [*out, own] if own else out


def cut(text: str) -> tuple[list[tuple[int, int]], list[str], list[int]]:
    """Places and texts of all tokens, and the sizes of the same sequences."""
    places = [m.span() for m in TOKEN.finditer(text)]
    tokens = [text[a:b] for a, b in places]
    sizes, first = [], 0
    for i in [i for i, t in enumerate(tokens) if t in ENDS]:
        while i - first >= LONGEST:
            sizes.append(LONGEST)
            first += LONGEST
        if i + 1 - first == LONGEST or not (i > first and len(tokens[i - 1]) <= 3 and tokens[i - 1][0].isupper()):
            sizes.append(i + 1 - first)
            first = i + 1
    while len(tokens) - first > LONGEST:
        sizes.append(LONGEST)
        first += LONGEST
    return places, tokens, [*sizes, len(tokens) - first] if first < len(tokens) else sizes


def _shape(token: str) -> str:
    kinds = "".join("X" if c.isupper() else "x" if c.islower() else "9" if c.isdigit() else "." for c in token)
    return re.sub(r"(.)\1+", r"\1+", kinds)


def _hash(feature: str) -> int:
    return zlib.crc32(feature.encode()) % FEATURES


def _own(token: str) -> tuple[str, tuple[int, ...], int, int]:
    """Shape of a token, its hashed features, and those that it is to the token after and before it."""
    low, shape = token.lower(), _shape(token)
    return shape, (_hash(f"w{low}"), _hash(f"s{shape}"), _hash(f"p{low[:3]}"), _hash(f"e{low[-3:]}")), _hash(f"b{low}"), _hash(f"a{low}")


class _Seen(dict):
    """Numbers of tokens; `table` holds the hashed features of each, and its shape's number, once `rows` are taken in. `<` and `>` stand around a sequence."""

    def __init__(self):
        self.shapes: dict[str, int] = {}
        self.pairs: dict[int, tuple[int, int]] = {}
        self.rows: list[tuple[int, ...]] = []
        self.table = np.zeros((0, 7), np.int64)
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.pairs.clear()
        self.shapes = {"<": 0, ">": 1}
        self.rows, self.table = [(0, 0, 0, 0, _hash("b<"), 0, 0), (0, 0, 0, 0, 0, _hash("a>"), 1)], self.table[:0]

    def __missing__(self, token: str) -> int:
        shape, own, before, after = _own(token)
        self.rows.append((*own, before, after, self.shapes.setdefault(shape, len(self.shapes))))
        self[token] = number = len(self.table) + len(self.rows) - 1
        return number

    def of(self, numbers: np.ndarray) -> np.ndarray:
        if self.rows:
            self.table = np.concatenate([self.table, np.array(self.rows, np.int64)])
            self.rows = []
        return self.table[numbers]

    def neighbours(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of pairs of neighbouring shapes: what they are to the second token, and to the first."""
        pair, at = np.unique(first * (1 << 32) + second, return_inverse=True)
        new = [p for p in pair.tolist() if p not in self.pairs]
        if new:
            names = list(self.shapes)
            for p in new:
                x, y = names[p >> 32], names[p & 0xFFFFFFFF]
                self.pairs[p] = _hash(f"B{x} {y}"), _hash(f"A{y} {x}")
        both = np.array([self.pairs[p] for p in pair.tolist()], np.uint16).reshape(-1, 2)[at]
        return both[:, 0], both[:, 1]


def sequence_features(tokens: Sequence[str], size: np.ndarray, seen: _Seen) -> np.ndarray:
    """Hashed features of each token of sequences of these sizes laid end to end: itself, its shape and ends, and its neighbours. `seen` keeps
    those of earlier tokens."""
    if len(seen) > MOST_SEEN:
        seen.clear()
    size = np.asarray(size, np.int64)
    place = np.arange(len(tokens)) + 2 * np.repeat(np.arange(len(size)), size) + 1
    number = np.zeros(len(tokens) + 2 * len(size), np.int64)
    number[np.cumsum(size + 2) - 1] = 1
    number[place] = np.fromiter(map(seen.__getitem__, tokens), np.int64, len(tokens))
    rows = seen.of(number)
    to_second, to_first = seen.neighbours(rows[:-1, 6], rows[1:, 6])
    out = np.empty((len(tokens), 9), np.uint16)
    out[:, :4], out[:, 4], out[:, 5] = rows[place, :4], rows[place - 1, 4], rows[place + 1, 5]
    out[:, 6], out[:, 7], out[:, 8] = to_second[place - 1], to_first[place], _hash("1")
    return out


def token_features(tokens: Sequence[str], seen: _Seen | None = None) -> np.ndarray:
    """The same for one sequence."""
    return sequence_features(tokens, np.array([len(tokens)]), _Seen() if seen is None else seen).astype(np.int64)


def _by_first_token(hits: Sequence[tuple[str, str]]) -> dict[str, list[tuple[str, str]]]:
    """Known (type, text) pairs by the token they begin with; a text that begins with none covers no tokens."""
    out: dict[str, list[tuple[str, str]]] = {}
    for kind, part in set(hits):
        first = TOKEN.match(part)
        if first:
            out.setdefault(first.group(), []).append((kind, part))
    return out


def _gold(text: str, places: list[tuple[int, int]], known: dict[str, list[tuple[str, str]]], tags: Sequence[str]) -> np.ndarray:
    out = np.zeros(len(places), np.int64)
    found = [(-len(part), kind, part, i) for i, (a, b) in enumerate(places) for kind, part in known.get(text[a:b], ()) if text.startswith(part, a)]
    if found:
        last = {b: i for i, (_, b) in enumerate(places)}
        for size, kind, _, i in sorted(found):
            end = last.get(places[i][0] - size)
            if end is not None and not out[i : end + 1].any():
                out[i : end + 1] = tags.index(kind)
    return out


def _gold_of_all(text: str, places: list[tuple[int, int]], tokens: list[str], sizes: list[int], known: dict[str, list[tuple[str, str]]], tags: Sequence[str]) -> np.ndarray:
    """The same for all sequences of a text, laid end to end."""
    out = np.zeros(len(places), np.int64)
    found = [(-len(part), kind, part, i) for i, t in enumerate(tokens) if t in known for kind, part in known[t] if text.startswith(part, places[i][0])]
    if found:
        last, ends = {b: i for i, (_, b) in enumerate(places)}, list(itertools.accumulate(sizes))
        for size, kind, _, i in sorted(found):
            end = last.get(places[i][0] - size)
            if end is not None and end < ends[bisect.bisect_right(ends, i)] and not out[i : end + 1].any():
                out[i : end + 1] = tags.index(kind)
    return out


def gold_tags(text: str, places: list[tuple[int, int]], hits: Sequence[tuple[str, str]], tags: Sequence[str]) -> np.ndarray:
    """Tags of the tokens that known (type, text) pairs cover wherever they stand; longer texts first."""
    return _gold(text, places, _by_first_token(hits), tags)


# ---------------------------------------------------------------- best paths


def ragged_paths(scores: np.ndarray, size: np.ndarray, moves: np.ndarray, margins: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Tags (tokens) of the best paths through the scores (tokens x tags) of sequences of these sizes laid end to end, of equal ones that
    of the least tags from the end on; and the margins: best path against the best one with another tag there.

    All sequences take a step together, the longest ones first, so that those that go on are the first ones."""
    order = np.argsort(-size, kind="stable")
    live = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), side="left")  # sequences that reach a position
    first = (np.cumsum(size) - size)[order]
    place = np.concatenate([np.zeros(0, np.int64), *[first[:n] + i for i, n in enumerate(live)]])
    cut = np.append(0, np.cumsum(live))
    own, k = scores[place], scores.shape[1]
    into, onto = np.ascontiguousarray(moves[:-1].T), moves[:-1]
    ahead, back = own + moves[-1], np.zeros(own.shape, np.int64)
    for i in range(1, len(live)):
        here, before = slice(cut[i], cut[i + 1]), slice(cut[i - 1], cut[i - 1] + live[i])
        step = ahead[before, None, :] + into
        back[here] = step.argmax(2)
        ahead[here] = step.max(2) + own[here]
    tags, after = np.empty(len(place), np.int64), 0
    for i in range(len(live) - 1, -1, -1):
        goes = cut[i] + after
        if after:
            tags[cut[i] : goes] = back[np.arange(cut[i + 1], cut[i + 1] + after), tags[cut[i + 1] : cut[i + 1] + after]]
        if live[i] > after:
            tags[goes : cut[i + 1]] = ahead[goes : cut[i + 1]].argmax(1)
        after = live[i]
    out = np.empty_like(tags)
    out[place] = tags
    if not margins:
        return out, None
    if k == 1:
        return out, np.full(len(out), np.inf)
    behind = np.zeros_like(own)
    for i in range(len(live) - 2, -1, -1):
        following = slice(cut[i + 1], cut[i + 2])
        behind[cut[i] : cut[i] + live[i + 1]] = (onto + (own[following] + behind[following])[:, None, :]).max(2)
    through = ahead + behind
    best = np.take_along_axis(through, tags[:, None], 1)[:, 0]
    np.put_along_axis(through, tags[:, None], -np.inf, 1)
    margin = np.empty(len(out))
    margin[place] = best - through.max(1)
    return out, margin


def best_paths(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for scores (sequences x tokens x tags) of sequences of one size."""
    n, length, k = scores.shape
    tags, margins = ragged_paths(scores.reshape(-1, k), np.full(n, length), moves)
    return tags.reshape(n, length), margins.reshape(n, length)


def tagged(model: Recogniser, features: np.ndarray, size: np.ndarray, margins: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Tags and margins of the tokens of sequences laid end to end, by token features."""
    scores = model.features[features[:, 0]]
    for i in range(1, features.shape[1]):
        scores += model.features[features[:, i]]
    return ragged_paths(scores, size, model.moves, margins)


# ---------------------------------------------------------------- learning


class _Learner:
    """Corrections of one partition, and the mean of the weights over its steps."""

    def __init__(self, model: Recogniser):
        self.model, self.steps = Recogniser(model.tags, model.features.copy(), model.moves.copy()), 0
        self.late = [np.zeros_like(model.features), np.zeros_like(model.moves)]  # corrections times the step they came with

    def learn(self, features: np.ndarray, size: np.ndarray, gold: np.ndarray, tags: np.ndarray | None = None) -> None:
        """One step: every weight moves by at most 1, whatever the number of sequences that ask for it. `tags` are those of the
        best paths, if they are known."""
        start = k = len(self.model.tags)
        features = features.astype(np.int64)
        if tags is None:
            tags, _ = tagged(self.model, features, size, margins=False)
        wrong, begin = tags != gold, np.cumsum(size) - size
        if wrong.any():
            missed = np.repeat(np.add.reduceat(wrong, begin) > 0, size)
            moved: tuple[list, list] = ([], [])
            for which, sign in ((gold, 1.0), (tags, -1.0)):
                before = np.append(start, which[:-1])
                before[begin] = start
                moved[0].append((features[wrong] * k + which[wrong, None]).ravel())
                moved[1].append((before * k + which)[missed])
            for own, late, (up, down) in zip((self.model.features, self.model.moves), self.late, moved, strict=True):
                at, which = np.unique(np.concatenate([up, down]), return_inverse=True)
                change = np.clip(np.bincount(which, np.repeat([1.0, -1.0], [len(up), len(down)])), -1, 1)
                own.ravel()[at] += change
                late.ravel()[at] += change * self.steps
        self.steps += 1

    def learn_all(self, steps: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """One step after the other. Weights stay as they are while steps are right, so the next ones are tagged together, up to the first wrong one."""
        at, many = 0, 1
        while at < len(steps):
            features, size, gold = (np.concatenate(x) for x in zip(*steps[at : at + many], strict=True))
            tags, _ = tagged(self.model, features, size, margins=False)
            wrong = np.flatnonzero(tags != gold)
            if not len(wrong):
                self.steps += len(steps[at : at + many])
                at, many = at + many, min(many * 2, MOST_STEPS)
                continue
            ends = np.cumsum([len(x[2]) for x in steps[at : at + many]])
            right = int(np.searchsorted(ends, wrong[0], "right"))
            self.steps += right
            begin = int(ends[right] - len(steps[at + right][2]))
            self.learn(*steps[at + right], tags[begin : ends[right]])
            at, many = at + right + 1, max(min(many, 2 * right), 1)

    def mean(self) -> np.ndarray:
        n = max(self.steps, 1)
        return np.concatenate([(own - late / n).ravel() for own, late in ((self.model.features, self.late[0]), (self.model.moves, self.late[1]))])


_STEPS = "sizes binary, features binary, kinds array<string>, gold binary"


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `STEP` sequences each: their sizes, hashed token features and known tags, as places in `kinds`."""
    seen = _Seen()
    for batch in batches:
        rows, kinds = [], [NONE]
        sizes, tokens, gold = [], [], []

        def close(last: bool) -> None:
            """All full steps; with `last`, the rest as well."""
            steps = range(0, len(sizes) if last else len(sizes) // STEP * STEP, STEP)
            many = [sum(sizes[i : i + STEP]) for i in steps]
            upto = sum(many)
            used = min(len(steps) * STEP, len(sizes))
            features, tags = sequence_features(tokens[:upto], np.array(sizes[:used], np.int64), seen), np.concatenate([*gold, np.zeros(0, np.int64)])
            at = 0
            for i, n in zip(steps, many, strict=True):
                rows.append((np.array(sizes[i : i + STEP], np.uint8).tobytes(), features[at : at + n].tobytes(), list(kinds), tags[at : at + n].astype(np.uint8).tobytes()))
                at += n
            del sizes[:used], tokens[:upto]
            gold[:] = [tags[upto:]]

        for text, hits in zip(batch["text"].to_pylist(), batch["hits"].to_pylist(), strict=True):
            known = _by_first_token([(h["type"], h["text"]) for h in hits or [] if h["text"]])
            kinds += sorted({kind for own in known.values() for kind, _ in own} - set(kinds))
            places, own, cuts = cut(text or "")
            sizes += cuts
            tokens += own
            gold.append(_gold_of_all(text, places, own, cuts, known, kinds) if known else np.zeros(len(own), np.int64))
            if len(tokens) >= AT_ONCE and len(sizes) >= STEP:
                close(False)
        if sizes:
            close(True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 4, (pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary()), strict=True)], ["sizes", "features", "kinds", "gold"])


def _round(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, tokens = _Learner(pickle.loads(shared.value)), 0
        for batch in batches:
            steps = []
            for sizes, features, kinds, gold in zip(*(batch[c].to_pylist() for c in ("sizes", "features", "kinds", "gold")), strict=True):
                size = np.frombuffer(sizes, np.uint8).astype(np.int64)
                tags = np.array([learner.model.tags.index(x) for x in kinds], np.int64)
                steps.append((np.frombuffer(features, np.uint16).reshape(int(size.sum()), -1), size, tags[np.frombuffer(gold, np.uint8)]))
                tokens += int(size.sum())
            learner.learn_all(steps)
        if tokens:
            mean = learner.mean()
            place = np.flatnonzero(mean)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, place), pa.int64()), pa.array(np.append(1.0, mean[place]) * tokens)], ["place", "value"])

    return run


def fit(docs: DataFrame, rounds: int = 5, text: str = "text", hits: str = "hits") -> Recogniser:
    """Learn from texts and the (type, text) pairs that are known to be in them."""
    spark = docs.sparkSession
    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(hits).alias("hits"))
    rows = written(rows.mapInArrow(_steps, _STEPS), "steps")  # read in every round, tokenised once
    types = [r.kind for r in rows.select(F.explode("kinds").alias("kind")).where(F.col("kind") != NONE).distinct().collect()]  # as many as types
    model = Recogniser.blank(types)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(model))
        sums = rows.mapInArrow(_round(shared), "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
        place, value = sums["place"].to_numpy(), sums["value"].to_numpy()  # at most one number a weight
        if not len(place):
            return model
        flat = np.zeros(model.features.size + model.moves.size)
        flat[place[place >= 0]] = value[place >= 0] / value[place < 0][0]
        model = Recogniser(model.tags, flat[: model.features.size].reshape(model.features.shape), flat[model.features.size :].reshape(model.moves.shape))
    return model


def _found(kinds: Sequence[str], row: int, text: str, places: list[tuple[int, int]], tags: np.ndarray, margins: np.ndarray) -> list[tuple]:
    """(row, type, text, score) of each run of equal tags in a sequence."""
    cuts = np.flatnonzero(np.append(True, tags[1:] != tags[:-1]))
    return [(row, kinds[tags[a]], text[places[a][0] : places[b - 1][1]], float(1 / (1 + np.exp(-margins[a:b].min())))) for a, b in zip(cuts, np.append(cuts[1:], len(tags)), strict=True) if tags[a]]


def recognised(docs: DataFrame, model: Recogniser, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, type, text, score) of every entity found, scores between 0 and 1."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = pickle.loads(shared.value), _Seen()
        for batch in batches:
            rows, where, sizes, tokens = [], [], [], []

            def tag() -> None:
                """Entities of the sequences at hand."""
                tags, margins = tagged(own, sequence_features(tokens, np.array(sizes), seen), np.array(sizes))
                at = 0
                for i, t, places in where:
                    if tags[at : at + len(places)].any():
                        rows.extend(_found(own.tags, i, t, places, tags[at : at + len(places)], margins[at : at + len(places)]))
                    at += len(places)
                for x in (where, sizes, tokens):
                    x.clear()

            for i, t in enumerate(batch["text"].to_pylist()):
                places, words, cuts = cut(t or "")
                at = 0
                for n in cuts:
                    where.append((i, t, places[at : at + n]))
                    at += n
                sizes += cuts
                tokens += words
                if len(sizes) >= TOGETHER:
                    tag()
            if sizes:
                tag()
            at, kinds, texts, scores = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(at, pa.int64())), pa.array(kinds, pa.string()), pa.array(texts, pa.string()), pa.array(scores, pa.float64())], ["id", "type", "text", "score"])

    found = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, type string, text string, score double")
    return found.withColumnRenamed("id", doc_id)
