"""Language-model scores by online logistic mixing of hashed contexts.

A text is a sequence of bytes and an end. A byte is a leaf of a Huffman tree (the most common
symbols; the others share an escape leaf and their shares of it), so that it takes about four binary
decisions instead of eight. Each decision is predicted by several contexts (two, three and five symbols
back, and the word so far), hashed to `SLOTS` rows each: a row's counts below a tree node give
that context's log odds. The odds are mixed with weights chosen by a gate (the tree node, and whether the
longest context is known there), and refined by an adaptive map from (node, mixed odds) to probability. The
weights and the map are learned over all training texts. They go on learning within every text, after each block of
`BLOCK` symbols, as do the shares of the rarer bytes. Every text begins from the same state and has weights and a map of its
own, so its score does not depend on its neighbours; `LANES` texts are walked side by side, and a lane that is through with its text takes the next one.
Decisions are taken node by node: positions in the order of their leaves' paths have those below a node in one range, and a row of
a table is read in pieces of `WORD` nodes that lie together in the tree.

Fitting: symbols and context rows are counted over all training texts, whatever their number and length
(map-side arrays, summed in two rounds, the first one salted); the tables have a fixed size (`SLOTS` x 64
bytes a context) and are collected and broadcast. The training texts are dealt into `PARTS` parts by a hash of
the text, so that copies are in one part. Weights and map are learned in one pass over all texts by the tables of the other
parts, which see a text as an unseen one. Every partition learns online, a step after each `STEP_SYMBOLS`; the weights
are the mean, over all decisions of all partitions, of those that a decision was made with, and the map
has the decisions themselves. Scores come from the tables of all parts.

The unigram base counts every token of all training texts. A slice of texts sends its different
tokens to buckets and gets their totals back; the tokens in order stay with the slice.

Defined results: null and empty texts consist of the end. Without training texts all
decisions cost one bit. Rows that repeat a doc_id are scored each on their own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, SPACE, Words, crc_fold, given_id, grouped, keyed, mix, partitions, runs, share, slices, text_buffers
from millrace.session import written

LEAVES, SLOTS, CHUNK, WORD = 64, 1 << 16, 1024, 8
WORD_BITS = (LEAVES // WORD).bit_length() - 1
CONTEXTS, LONGEST, GATES = 4, 2, 2 * LEAVES
BLOCK, LANES, TEXT_SLICE, SCORE_SLICE, SYMBOL_SLICE = 160, 64, 500_000, 4_000_000, 50_000
SCALE, PRIOR = 12.0, 0.3
PARTS, STEP_SYMBOLS, LEARNING, FADING, DAMP = 4, 4096, 1.0, 0.95, 8.0
# Mixed odds are whole multiples of 1 / UNIT; the map has a cell for 2**CELL_BITS of them.
RATE, MAP_PRIOR, UNIT, CELL_BITS, CELLS = 0.02, 32.0, 512, 6, 128
SALT = 16
BUCKETS_PER_PARTITION = 8
END = 256
_SYMBOL = mix(np.arange(1, LEAVES + 1, dtype=np.uint64)).astype(np.uint32)
_BITS = np.tile(np.arange(2), LEAVES - 1)
_POWER = np.cumprod(np.full(4096, 0x9E3779B1, np.uint32), dtype=np.uint32)


class Tree:
    """The Huffman tree over the leaves: END, the most common bytes, and an escape."""

    def __init__(self, counts: np.ndarray):
        common = np.argsort(-counts, kind="stable")[: LEAVES - 2]
        rare = np.setdiff1d(np.arange(256), common)
        self.end, self.escape = 0, LEAVES - 1
        self.leaf = np.full(256, self.escape, np.int32)
        self.leaf[common] = np.arange(1, LEAVES - 1)
        self.cost = np.zeros(256)  # bits of a byte beyond its leaf
        self.cost[rare] = np.log2((counts[rare] + 1).sum() / (counts[rare] + 1))
        self.blank = np.zeros(LEAVES, bool)
        self.blank[0] = True
        self.blank[self.leaf[SPACE & (self.leaf != self.escape)]] = True
        self.of = np.append(self.leaf, np.int32(self.end))  # by code: a byte, or END
        self.mark = np.where(self.blank, np.uint32(0), _SYMBOL).take(self.of)
        self.parts = self.blank.take(self.of)
        weight = np.append(counts[common], counts[rare].sum())
        heap = [(int(w) + 1, i, i + 1) for i, w in enumerate(weight)] + [(int(counts.sum()) // 1000 + 1, len(weight), 0)]
        heapq.heapify(heap)
        below: dict[int, list[int]] = {i: [i] for i in range(LEAVES)}
        paths: list[list[tuple[int, int]]] = [[] for _ in range(LEAVES)]
        inner: list[tuple] = []  # of a node, its weight and the nodes right below it
        for node in range(LEAVES - 1):
            (wa, _, a), (wb, _, b) = heapq.heappop(heap), heapq.heappop(heap)
            for bit, child in ((0, a), (1, b)):
                for leaf in below[child]:
                    paths[leaf].append((node, bit))
            below[LEAVES + node] = below[a] + below[b]
            inner.append((wa + wb, [x - LEAVES for x in (a, b) if x >= LEAVES]))
            heapq.heappush(heap, (wa + wb, LEAVES + node, LEAVES + node))
        pieces = _pieces(inner)
        number = {node: i for i, node in enumerate(sum(pieces, []))}
        paths = [[(number[node], bit) for node, bit in path] for path in paths]
        self.zero, self.one = np.zeros((LEAVES, LEAVES), np.float64), np.zeros((LEAVES, LEAVES), np.float64)
        for leaf, path in enumerate(paths):
            for node, bit in path:
                (self.one if bit else self.zero)[leaf, node] = 1
        self.size = np.array([len(p) for p in paths], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.node = np.array([n for p in paths for n, _ in p], np.intp)
        self.bit = np.array([b for p in paths for _, b in p], np.intp)
        # In the order of their paths from the root, the leaves below a node stand together: from `low` to `high`, those with bit 1 from `middle`.
        order = sorted(range(LEAVES), key=lambda leaf: [b for _, b in reversed(paths[leaf])])
        self.rank = np.argsort(order).astype(np.uint8)
        spans = [[[int(self.rank[leaf]) for leaf in np.flatnonzero(table[:, node])] for table in (self.zero, self.one)] for node in range(LEAVES - 1)]
        self.low, self.middle, self.high = np.array([(min(z), min(o), max(o) + 1) for z, o in spans], np.intp).T
        # Nodes that are read together: of one piece of the tree, and in the same `WORD` bytes of a row.
        groups: dict[tuple, list[int]] = {}
        for i, piece in enumerate(pieces):
            for node in piece:
                groups.setdefault((i, number[node] // WORD), []).append(number[node])
        self.read = [(word, int(self.low[nodes].min()), int(self.high[nodes].max()), nodes) for (_, word), nodes in groups.items()]


def _pieces(inner: list[tuple]) -> list[list[int]]:
    """The nodes as connected pieces of up to `WORD` nodes, the heaviest ones together and whole pieces first."""
    tops, pieces = [(-inner[-1][0], len(inner) - 1)], []
    while tops:
        near, piece = [heapq.heappop(tops)], []
        while near and len(piece) < WORD:
            _, node = heapq.heappop(near)
            piece.append(node)
            for child in inner[node][1]:
                heapq.heappush(near, (-inner[child][0], child))
        for top in near:
            heapq.heappush(tops, top)
        pieces.append(piece)
    return sorted(pieces, key=len, reverse=True)


class Symbols:
    """Texts as leaves, each followed by the end, with the context rows of every position."""

    def __init__(self, tree: Tree, data: np.ndarray, offsets: np.ndarray):
        self.tree, self.bounds = tree, np.append(0, np.cumsum(np.diff(offsets) + 1))
        self.code, self.leaf = np.empty(self.bounds[-1], np.uint16), np.empty(self.bounds[-1], np.uint8)
        self.rows = np.empty((self.bounds[-1], CONTEXTS), np.int32)  # of a position side by side: where rows begin, in words
        for a, b in slices(offsets, SYMBOL_SLICE):  # no more at once than caches hold
            self._fill(data[offsets[a] : offsets[b]], np.diff(offsets[a : b + 1]), self.bounds[a : b + 1])

    def _fill(self, data: np.ndarray, length: np.ndarray, bounds: np.ndarray) -> None:
        tree, part = self.tree, slice(bounds[0], bounds[-1])
        bounds = bounds - bounds[0]
        total = bounds[-1]
        code, inside = np.full(total, END, np.intp), np.ones(total, bool)
        inside[bounds[1:] - 1] = False
        code[inside] = data
        leaf = tree.of.take(code, mode="clip")
        one, five = np.zeros(total, np.uint32), np.zeros(total, np.uint32)  # the five symbols before, the last one lowest
        one[1:] = leaf[:-1]
        five[:] = one
        five[1:] |= one[:-1] << np.uint32(6)
        five[2:] |= five[:-2] << np.uint32(12)
        five &= np.uint32((1 << 24) - 1)
        five[4:] |= one[:-4] << np.uint32(24)
        # Before a text stand ends only (leaf 0), not the text before.
        for j in range(5):
            at = bounds[:-1] + j
            five[at[at < bounds[1:]]] &= np.uint32((1 << 6 * j) - 1)
        index = np.arange(total + 1)
        word = np.zeros(total, np.intp)  # first position after the last blank
        np.maximum.accumulate((index[1:] * tree.parts.take(code, mode="clip"))[:-1], out=word[1:])
        summed = np.zeros(total + 1, np.uint32)
        index = index[:-1] - word
        index &= 4095
        np.cumsum(tree.mark.take(code, mode="clip") * _POWER.take(index, mode="clip"), out=summed[1:])
        prefix = summed[:-1] - summed.take(word, mode="clip")
        two = five & np.uint32((1 << 12) - 1)
        three = (five & np.uint32((1 << 18) - 1)) * np.uint32(0x9E3779B1)
        five *= np.uint32(0x9E3779B1)
        prefix = (prefix ^ (prefix >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        shift = np.uint32(32 - SLOTS.bit_length() + 1)
        self.code[part], self.leaf[part] = code, leaf
        for k, x in enumerate((two, three >> shift, five >> shift, prefix >> shift)):
            np.add(x << np.uint32(WORD_BITS), np.uint32(k * SLOTS << WORD_BITS), out=self.rows[part, k], casting="unsafe")

    @cached_property
    def slots(self) -> np.ndarray:
        """Context rows by context and position."""
        return (self.rows.T >> WORD_BITS) & (SLOTS - 1)

    def costs(self, a: int, b: int) -> np.ndarray:
        """Bits that the bytes at positions a to b need beyond their leaves at the start of a text."""
        return np.append(self.tree.cost, 0.0).take(self.code[a:b])


# ---------------------------------------------------------------- counting


def _symbol_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256, np.int64)
    for batch in batches:
        total += np.bincount(text_buffers(batch["text"])[0], minlength=256)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], ["symbol", "n"])


def _context_counts(tree, part: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts, any_row = tree(), np.zeros((CONTEXTS, SLOTS * LEAVES), np.uint32), False
        one = np.uint32(1)
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets, TEXT_SLICE):
                s = Symbols(own, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                any_row = True
                for k in range(CONTEXTS):
                    cell = s.rows[:, k] * np.intp(WORD)
                    cell += s.leaf
                    np.add.at(counts.reshape(-1), cell, one)
        if any_row:
            salt = TaskContext.get().partitionId() % SALT
            for k in range(CONTEXTS):
                for c, chunk in enumerate(counts[k].reshape(-1, CHUNK * LEAVES)):
                    if chunk.any():
                        yield _chunk(k, c, part, salt, chunk.astype(np.uint64))

    return run


_CHUNK_SQL = "k int, c int, part int, salt int, counts binary"


def _chunk(k: int, c: int, part: int, salt: int, counts: np.ndarray) -> pa.RecordBatch:
    data = pa.compress(counts.tobytes(), codec="zstd", asbytes=True)
    return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in (k, c, part, salt)), pa.array([data], pa.binary())], ["k", "c", "part", "salt", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> dict[tuple, np.ndarray]:
    """Counts by (k, c, part, salt) of the partition; rows are added as they come."""
    sums: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for *key, data in zip(*(batch[x].to_pylist() for x in ("k", "c", "part", "salt", "counts")), strict=True):
            counts = np.frombuffer(pa.decompress(data, CHUNK * LEAVES * 8, codec="zstd", asbytes=True), np.uint64)
            sums[tuple(key)] = sums[tuple(key)] + counts if tuple(key) in sums else counts
    return sums


def _chunk_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, counts in _summed(batches).items():
        yield _chunk(*key, counts)


def log_odds(tree: Tree, counts: np.ndarray) -> np.ndarray:
    """Rounded log odds of the tree nodes from leaf counts (rows x leaves)."""
    ones, zeros = counts @ tree.one, counts @ tree.zero
    return np.clip(np.rint(SCALE * np.log((ones + PRIOR) / (zeros + PRIOR))), -127, 127).astype(np.int8)


def _tables(tree):
    """Log odds of each chunk from the counts of all parts (part -1) and of all parts but one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, chunks = tree(), {}
        for (k, c, part, _), counts in _summed(batches).items():
            chunks.setdefault((k, c), {})[part] = counts
        for (k, c), by_part in chunks.items():
            total = sum(by_part.values())
            for part in (-1, *range(PARTS)):
                left = total - by_part[part] if part in by_part else total
                odds = log_odds(own, left.reshape(CHUNK, LEAVES).astype(float))
                yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in (k, c, part)), pa.array([odds.tobytes()], pa.binary())], ["k", "c", "part", "odds"])

    return run


# ---------------------------------------------------------------- mixing


class Mixer:
    """Weights (contexts x gates) and the refining map (nodes x cells)."""

    def __init__(self, tree: Tree, tables: np.ndarray):
        self.tree, self.tables = tree, tables  # tables: contexts x (SLOTS * LEAVES), int8
        self.weights = np.full((CONTEXTS, GATES), 0.4, np.float32)
        middle = ((np.arange(CELLS) + 0.5 - CELLS / 2) * 2**CELL_BITS) / UNIT
        self.map = np.tile(1 / (1 + np.exp(-middle)), (LEAVES, 1))
        self.curves = np.zeros((CONTEXTS, GATES))
        self.escaped = int(tree.rank[tree.escape])

    def inputs(self, s: Symbols, a: int, b: int) -> tuple:
        """First decision of each node that has some; node, bit, log odds by context (times `SCALE`) and gate of the decisions of positions a to b."""
        _, _, spans, *found = self.inputs_at(s, np.arange(a, b))
        return np.array([start for _, start, _, _ in spans]), *found

    def inputs_at(self, s: Symbols, at: np.ndarray, lane: np.ndarray | None = None, lanes: int = 1) -> tuple:
        """The positions in the order of their leaves' paths; where leaves begin in it; by node that has decisions: the node, where they
        begin, and the range of their positions; and node, bit, log odds and gate of the decisions, node by node. If texts
        lie in `lanes`, each has nodes and gates of its own: those of a tree node stand side by side."""
        tree = self.tree
        rank = tree.rank.take(s.leaf.take(at, mode="clip"), mode="clip")
        order, upto = np.argsort(rank, kind="stable"), np.append(0, np.cumsum(np.bincount(rank, minlength=LEAVES)))
        low, middle, high = upto.take(tree.low), upto.take(tree.middle), upto.take(tree.high)
        size = high - low
        bit = np.repeat(_BITS, np.stack([middle - low, high - middle], axis=1).reshape(-1))
        rows = s.rows.view(np.complex128).reshape(-1).take(at.take(order, mode="clip"), mode="clip").view(np.int32).reshape(-1, CONTEXTS)
        first = rows.T.astype(np.intp, order="C")
        words = self.tables.reshape(-1).view(np.int64)
        x = np.empty((CONTEXTS, len(bit)), np.float32)
        node = np.repeat(np.arange(LEAVES - 1) * lanes, size)
        if lane is not None:
            lane = lane.take(order, mode="clip")
        spans = list(zip(range(LEAVES - 1), (np.cumsum(size) - size).tolist(), low.tolist(), high.tolist(), strict=True))
        for word, least, most, nodes in tree.read:
            begin, stop = int(upto[least]), int(upto[most])
            if begin < stop:
                found = words.take(first[:, begin:stop] + word, mode="clip").view(np.int8).reshape(CONTEXTS, stop - begin, WORD)
                for i in nodes:
                    _, a, b, c = spans[i]
                    if b < c:
                        x[:, a : a + c - b] = found[:, b - begin : c - begin, i % WORD]
                        if lane is not None:
                            node[a : a + c - b] += lane[b:c]
        spans = [span for span in spans if span[2] < span[3]]
        gate = 2 * node
        gate += x[LONGEST] == 0
        return order, upto, spans, node, bit, x, gate

    @staticmethod
    def step(x: np.ndarray, gate: np.ndarray, bit: np.ndarray, weights: np.ndarray, odds: np.ndarray) -> None:
        """One online step of the weights, in place, of the gates that the decisions use."""
        error, gates = bit.astype(np.float32) - _probability(odds), weights.shape[1]
        rate = RATE / SCALE / (1 + np.bincount(gate, minlength=gates) / 32)
        for k in range(CONTEXTS):
            weights[k] += rate * np.bincount(gate, error * x[k], gates)

    @staticmethod
    def _places(node: np.ndarray, odds: np.ndarray) -> np.ndarray:
        """Place in the map of decisions with these mixed odds."""
        most = CELLS * 2**CELL_BITS // 2  # beyond, odds count as the map's last cell
        whole = odds * np.float32(UNIT)
        np.clip(np.rint(whole, out=whole), -most, most - 1, out=whole)
        whole += most
        cell = whole.astype(np.int32)
        cell >>= CELL_BITS
        place = node * CELLS
        place += cell
        return place

    def text_bits(self, s: Symbols, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Cost of the texts at positions `first` to `last`. They go on block by block in up to `LANES` lanes, side by side; a lane that is through with its text takes
        the next one. After each block a text's own weights, map and shares of the rarer bytes learn from it."""
        total, lanes = np.zeros(len(first)), min(LANES, len(first))
        # What a text begins with; the lanes of a node stand side by side.
        start = np.ascontiguousarray(self.weights.T).reshape(LEAVES, 1, 2, CONTEXTS)
        told = (MAP_PRIOR * np.stack([1 - self.map, self.map], axis=-1)).astype(np.float32).reshape(LEAVES, 1, -1)
        usual, ahead = MAP_PRIOR * 2.0**-self.tree.cost, np.arange(BLOCK)[:, None]
        weights, seen, shares, rare = np.repeat(start, lanes, 1), np.repeat(told, lanes, 1), np.tile(usual, (lanes, 1)), np.full(lanes, MAP_PRIOR)
        text, following = np.arange(lanes), lanes
        here, end = first[:lanes].copy(), last[:lanes].copy()
        while lanes:
            upto = np.minimum(here + BLOCK, end)
            at = here + ahead  # first symbols of all texts, then second ones
            within = np.flatnonzero(at < upto)
            at, lane = at.reshape(-1).take(within, mode="clip"), within % lanes
            order, ranks, spans, node, bit, x, gate = self.inputs_at(s, at, lane, lanes)
            lane = lane.take(order, mode="clip")
            mixing = weights.reshape(-1, CONTEXTS).T
            odds = self.mixed(x, gate, mixing)
            own = self._places(node, odds)
            own *= 2
            own += bit
            counts = seen.reshape(-1)
            p = counts.take(own, mode="clip")
            p /= p + counts.take(own ^ 1, mode="clip")
            np.log2(np.clip(p, 1e-6, 1 - 1e-6, out=p), out=p)
            cost = np.zeros(len(at), np.float32)  # of a position, all its decisions
            for _, i, j, k in spans:
                cost[j:k] += p[i : i + k - j]
            bits = np.bincount(lane, cost, lanes)
            far = slice(*ranks[self.escaped : self.escaped + 2])
            whose = lane[far]
            byte = whose * 256 + s.code.take(at.take(order[far]))
            bits += np.bincount(whose, np.log2(shares.reshape(-1).take(byte) / rare.take(whose)), lanes)
            total[text] -= bits
            through, here = np.flatnonzero((upto == end) & (here < end)), upto
            alive = here < end
            if alive.any():
                self.step(x, gate, bit, mixing, odds)
                np.add.at(counts, own, np.float32(1))
                np.add.at(shares.reshape(-1), byte, 1.0)
                rare += np.bincount(whose, minlength=lanes)
            fresh = through[: len(first) - following]
            if len(fresh):
                text[fresh] = np.arange(following, following + len(fresh))
                here[fresh], end[fresh], alive[fresh] = first[text[fresh]], last[text[fresh]], True
                weights[:, fresh], seen[:, fresh], shares[fresh], rare[fresh] = start, told, usual, MAP_PRIOR
                following += len(fresh)
            if 2 * alive.sum() <= lanes:
                text, here, end, shares, rare = (v[alive] for v in (text, here, end, shares, rare))
                weights, seen, lanes = weights.compress(alive, 1), seen.compress(alive, 1), len(text)
        return total

    @staticmethod
    def mixed(x: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Mixed odds. The weights of a gate are taken at once, as one item of 16 bytes."""
        items = np.ascontiguousarray(weights.T).view(np.complex128).reshape(-1)
        taken = items.take(gate, mode="clip").view(np.float32).reshape(-1, CONTEXTS)
        odds = x[0] * taken[:, 0]
        for k in range(1, CONTEXTS):
            odds += x[k] * taken[:, k]
        odds *= np.float32(1 / SCALE)
        return odds

    def _learned(self, seen: np.ndarray) -> np.ndarray:
        """The map after decisions counted by place and bit."""
        zero, one = seen.reshape(-1, 2).T
        return (MAP_PRIOR * self.map.reshape(-1) + one) / (MAP_PRIOR + zero + one)

    def learn(self, s: Symbols) -> np.ndarray:
        """Go over all positions once, learning weights on the way: after each `STEP_SYMBOLS` they move along the slope of
        the log likelihood, by no more than what its curvature of late allows. Returns, laid end to
        end, the weights times the decisions they were used for, these decisions by gate, and the decisions by place in the map and bit."""
        used, n, seen = np.zeros((CONTEXTS, GATES)), np.zeros(GATES), np.zeros(2 * self.map.size, np.int64)
        for a in range(0, len(s.leaf), STEP_SYMBOLS):
            first, node, bit, x, gate = self.inputs(s, a, min(a + STEP_SYMBOLS, len(s.leaf)))
            odds = self.mixed(x, gate, self.weights)
            place = self._places(node, odds)
            place *= 2
            place += bit
            seen += np.bincount(place, minlength=len(seen))
            p = _probability(odds)
            error = bit.astype(np.float32)
            error -= p
            # |x_k| times the sum of all |x| bounds the curvature, whatever the contexts share.
            sums = np.empty((2 * CONTEXTS, len(node)), np.float32)
            most = np.abs(x, out=sums[CONTEXTS:])
            bent = most[0] + most[1]
            for k in range(2, CONTEXTS):
                bent += most[k]
            bent *= p
            bent *= np.subtract(1, p, out=p)
            most *= bent
            np.multiply(x, error, out=sums[:CONTEXTS])
            # A node has two gates: the unknown decisions, few as a rule, are summed first, the others as they stand, node by node.
            unknown = np.flatnonzero(x[LONGEST] == 0)
            theirs, gates = gate.take(unknown), 2 * node[first]
            found = np.array([np.bincount(theirs, v, GATES) for v in [np.ones(len(unknown)), *sums.take(unknown, axis=1)]])
            sums[:, unknown] = 0
            found[0, gates] = np.diff(first, append=len(node)) - found[0, gates + 1]
            found[1:, gates] = np.add.reduceat(sums, first, axis=1)
            used += self.weights * found[0]
            n += found[0]
            self.curves = FADING * self.curves + found[1 + CONTEXTS :] / SCALE**2
            self.weights += LEARNING / SCALE * found[1 : 1 + CONTEXTS] / (self.curves + DAMP)
        return np.concatenate([used.reshape(-1), n, seen])

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text; the longest ones are begun first."""
        s = Symbols(self.tree, data, offsets)
        order, out = np.argsort(-np.diff(s.bounds), kind="stable"), np.zeros(len(offsets) - 1)
        out[order] = self.text_bits(s, s.bounds[order], s.bounds[order + 1])
        return out


def _probability(odds: np.ndarray) -> np.ndarray:
    p = np.clip(odds, -12, 12)
    np.exp(np.negative(p, out=p), out=p)
    p += 1
    return np.divide(1, p, out=p)


def _costs(probability: np.ndarray) -> np.ndarray:
    """Bits of a 0 and of a 1 at every place of the map."""
    p = np.clip(probability, 1e-6, 1 - 1e-6)
    return np.stack([-np.log2(1 - p), -np.log2(p)], axis=1).reshape(-1)


def fit(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> Mixer:
    """Learn from the texts of the rows where `train` holds."""
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    rows = keyed(docs.where(train), id_col, text_col)
    counts = rows.select("text").mapInArrow(_symbol_counts, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    symbol = np.zeros(256)
    for r in counts:
        symbol[r.symbol] = r.n
    tree = Tree(symbol)
    shared = share(spark, tree)
    texts = [rows.where(F.pmod("tag", F.lit(PARTS)) == part).select("text") for part in range(PARTS)]
    parts = _union(t.mapInArrow(_context_counts(shared, part), _CHUNK_SQL) for part, t in enumerate(texts))
    salted = parts.repartition(n, "k", "c", "part", "salt").mapInArrow(_chunk_sums, _CHUNK_SQL).withColumn("salt", F.lit(0))
    odds = salted.repartition(n, "k", "c").mapInArrow(_tables(shared), "k int, c int, part int, odds binary")
    tables = np.zeros((PARTS + 1, CONTEXTS, SLOTS // CHUNK, CHUNK * LEAVES), np.int8)  # the last of all parts
    for r in odds.toLocalIterator():  # (PARTS + 1) * CONTEXTS * SLOTS * 64 bytes
        tables[r.part, r.k, r.c] = np.frombuffer(r.odds, np.int8)
    tables = tables.reshape(PARTS + 1, CONTEXTS, -1)
    mixer = Mixer(tree, tables[-1].copy())
    learn_mixing(mixer, texts, shared, [share(spark, _Packed(t)) for t in tables[:-1]])
    return mixer


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def learn_mixing(mixer: Mixer, texts: list[DataFrame], tree, tables: list) -> None:
    """One pass over the texts of all parts, each part by its own tables. Every partition learns online; the weights are the mean of
    what all decisions were made with, the map has all decisions."""
    found = _union(t.mapInArrow(_learned(tree, own), "place int, value double") for t, own in zip(texts, tables, strict=True))
    out = np.zeros(CONTEXTS * GATES + GATES + 2 * mixer.map.size)
    for r in found.groupBy("place").agg(F.sum("value").alias("value")).collect():  # at most as many numbers as weights and places
        out[r.place] = r.value
    used, n, seen = np.split(out, [CONTEXTS * GATES, CONTEXTS * GATES + GATES])
    mixer.weights = np.where(n > 0, used.reshape(CONTEXTS, GATES) / np.maximum(n, 1), mixer.weights).astype(np.float32)
    mixer.map = mixer._learned(seen).reshape(mixer.map.shape)


def _learned(tree, tables):
    """What `Mixer.learn` returns for all texts of the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = None, 0
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets, TEXT_SLICE):
                own = own or Mixer(tree(), tables().tables())
                total = total + own.learn(Symbols(own.tree, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
        if own is not None:
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(total[place])], ["place", "value"])

    return run


def scored(docs: DataFrame, mixer: Mixer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tag, bits, n_bytes) of every whole text."""
    tree, state = share(docs.sparkSession, mixer.tree), share(docs.sparkSession, _State(mixer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = state()
        own = Mixer(tree(), held.packed.tables())
        own.weights, own.map = held.weights, held.map
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets, SCORE_SLICE):
                bits = own.score(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([batch["doc"].slice(a, b - a), batch["tag"].slice(a, b - a), pa.array(bits), pa.array(np.diff(offsets[a : b + 1]))], ["doc", "tag", "bits", "n_bytes"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "doc long, tag long, bits double, n_bytes long")


class _Packed:
    """Tables as they travel: a copy of what is broadcast lies on the disk of the driver and of every executor."""

    def __init__(self, tables: np.ndarray):
        self.shape, self.data = tables.shape, pa.compress(np.ascontiguousarray(tables), codec="zstd", asbytes=True)

    def tables(self) -> np.ndarray:
        size = int(np.prod(self.shape))
        return np.frombuffer(pa.decompress(self.data, size, codec="zstd", asbytes=True), np.int8).reshape(self.shape)


class _State:
    def __init__(self, mixer: Mixer):
        self.packed, self.weights, self.map = _Packed(mixer.tables), mixer.weights, mixer.map


# ---------------------------------------------------------------- unigram base


def _tokens(buckets: int):
    """Per slice: its different tokens and their training counts by bucket; and, with bucket -1,
    the texts and the tokens in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            doc, tag, train = (batch[c].to_numpy(zero_copy_only=False) for c in ("doc", "tag", "train"))
            for a, b in slices(offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                token, which = np.unique(words.hashes(LOWER), return_inverse=True)
                bucket = (mix(token) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                which = place[which] if len(order) else which
                counts = np.bincount(which, train[a:b][words.row], len(order)).astype(np.uint32)
                texts = doc[a:b].tobytes() + tag[a:b].tobytes() + words.count.astype(np.int64).tobytes()
                rows = [(number, -1, b - a, _zip(texts), _zip(which.astype(np.uint32).tobytes()))]
                for first, size in zip(*runs(np.append(True, np.diff(bucket[order]) != 0)), strict=True) if len(order) else ():
                    rows.append((number, int(bucket[order[first]]), int(size), token[order[first : first + size]].tobytes(), _zip(counts[first : first + size].tobytes())))
                yield _rows(rows)
                number += 1

    return run


def _zip(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True) if data else b""


def _unzip(data: bytes, kind, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


_ROW = pa.schema([("slice", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
_ROW_SQL = "slice long, bucket int, n int, a binary, b binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROW, strict=True)], schema=_ROW)


def _totals(group: pa.Table) -> pa.RecordBatch:
    """The counts of a bucket summed over slices and given back to each; slice -1 has the sums."""
    parts = list(zip(*(group[c].to_pylist() for c in ("slice", "n", "a", "b")), strict=True))
    token = np.concatenate([np.frombuffer(a, np.uint64) for _, _, a, _ in parts])
    count = np.concatenate([_unzip(b, np.uint32, n) for _, n, _, b in parts]).astype(np.int64)
    _, which = np.unique(token, return_inverse=True)
    total = np.bincount(which, count).astype(np.int64)
    bucket, at, rows = group["bucket"][0].as_py(), 0, [(-1, 0, 0, int(total.sum()).to_bytes(8, "little"), int((total > 0).sum()).to_bytes(8, "little"))]
    for number, n, _, _ in parts:
        rows.append((number, bucket, n, b"", _zip(total[which[at : at + n]].tobytes())))
        at += n
    return _rows(rows)


def _text_sums(group: pa.Table) -> pa.RecordBatch | None:
    """Per text of a slice: n_words, known words and the sum of log10(c + 0.5)."""
    parts = list(zip(*(group[c].to_pylist() for c in ("bucket", "n", "a", "b")), strict=True))
    _, n, texts, order = parts[0]
    doc, tag, count = _unzip(texts, np.int64, 3 * n).reshape(3, n)
    total = np.concatenate([np.zeros(0, np.int64), *[_unzip(b, np.int64, m) for _, m, _, b in parts[1:]]])
    which = _unzip(order, np.uint32, int(count.sum()))
    row = np.repeat(np.arange(n), count)
    value = np.bincount(row, np.log10(total + 0.5)[which], n)
    known = np.bincount(row, (total > 0)[which], n).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tag), pa.array(count), pa.array(known), pa.array(value)], ["doc", "tag", "n_words", "known", "logs"])


def unigram(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tag, n_tokens, n_known, train_tokens, base_score) of every different (doc, tag)."""
    n = partitions(docs.sparkSession)
    rows = keyed(docs, id_col, text_col, train=F.coalesce(train, F.lit(False)))
    texts = rows.where("train").count()
    sent = written(rows.mapInArrow(_tokens(n * BUCKETS_PER_PARTITION), _ROW_SQL), "tokens")
    counted = sent.where("bucket >= 0").repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(grouped(_totals, ["bucket"]), _ROW_SQL)
    counted = written(counted, "totals")
    size, distinct = texts, int(texts > 0)
    for r in counted.where("slice = -1").select("a", "b").collect():  # two numbers a bucket
        size += int.from_bytes(r.a, "little")
        distinct += int.from_bytes(r.b, "little")
    back = sent.where("bucket = -1").unionByName(counted.where("slice >= 0")).repartition(n, "slice").sortWithinPartitions("slice", "bucket")
    sums = back.mapInArrow(grouped(_text_sums, ["slice"]), "doc long, tag long, n_words long, known long, logs double").dropDuplicates(["doc", "tag"])
    per = float(np.log10(size + 0.5 * (distinct + 1)))
    return sums.select(
        "doc", "tag", (F.col("n_words") + 1).alias("n_tokens"), (F.col("known") + int(texts > 0)).alias("n_known"), F.lit(size).cast("long").alias("train_tokens"),
        (F.col("logs") + float(np.log10(texts + 0.5)) - (F.col("n_words") + 1) * per).alias("base_score"))


FOLDS, HELD_OUT = 5, 1


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = crc_fold(F.col("doc_id"), FOLDS)
    model = scored(docs, fit(docs, fold != HELD_OUT))
    out = model.join(unigram(docs, fold != HELD_OUT), ["doc", "tag"]).withColumn("doc_id", given_id())
    return out.select(
        "doc_id", (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
        (F.col("bits") * float(-np.log10(2))).alias("score"), (F.col("bits") / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
