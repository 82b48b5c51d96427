"""Boosted trees of second order on histograms, grown level by level over a Spark table.

Features are cut into bins once, at quantiles, and the binned rows are written, a batch of rows as one row of arrays. A pass over them gives
every level of every tree of a round: each partition adds up slopes and curvatures of the loss by
(class, node, feature, bin), the sums of all partitions meet by (class, node, block of features), and only the
best cut of each comes to the driver. Trees of all classes of a round grow together (softmax); with two classes there is
one tree a round (logistic). Sums are whole numbers, so the trees do not depend on the partitions.

A missing value (null or NaN) goes to the side that fits better, cut by cut. Rows are left out of a round by a hash of
their key. Scores of earlier rounds are kept in the table and renewed every `KEPT_ROUNDS` rounds.

Functions and trees travel to the Python workers by value, so executors do not need this package.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS, BLOCK_FEATURES, KEPT_ROUNDS = 64, 64, 5
UNIT = float(1 << 24)  # slopes and curvatures are counted in 1 / UNIT
ROWS_PER_TASK = 100_000
WORK_PER_TASK = 4_000_000  # rows x margins x (features + WALK): what a level costs
WALK = 32  # a row's way through the trees, in features


@dataclass
class Settings:
    """Rounds, depth, learning rate, share of rows a round, L2 on leaf values, least gain and least curvature of a leaf."""

    rounds: int = 100
    depth: int = 5
    eta: float = 0.3
    subsample: float = 1.0
    l2: float = 1.0
    gain: float = 0.0
    weight: float = 1.0
    seed: int = 42


class Tree:
    """A binary tree in heap order; `bin` is the last bin that goes left, `cut` its upper value."""

    def __init__(self, depth: int):
        n = (1 << depth + 1) - 1
        self.depth = depth
        self.feature = np.full(n, -1)
        self.bin, self.cut, self.missing_left = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
        self.value, self.gain = np.zeros(n), np.zeros(n)

    def leaves(self, x: np.ndarray, missing: np.ndarray | int, binned: bool, levels: int | None = None) -> np.ndarray:
        """The node each row ends in, after at most `levels` steps. Of binned rows, `missing` is the bin of missing values."""
        steps, rows = self.depth if levels is None else levels, np.arange(len(x))
        node = np.zeros(len(x), np.int64)
        if binned:
            bins, width = np.ascontiguousarray(x.T), missing + 1
            follows, start = self._follows(width), np.maximum(self.feature, 0) * len(x)
            for step in range(steps):
                at = bins.reshape(-1).take(start.take(node) + rows) if step else bins[max(self.feature[0], 0)]
                node = follows.take(node * width + at)
            return node
        for _ in range(steps):
            f = self.feature[node]
            inner = f >= 0
            left = np.where(missing[rows, f], self.missing_left[node], x[rows, f] <= self.cut[node])
            node = np.where(inner, 2 * node + 2 - left, node)
        return node

    def _follows(self, width: int) -> np.ndarray:
        """By node and bin, the node that comes next."""
        node = np.arange(len(self.feature))[:, None]
        left = np.arange(width) <= self.bin[:, None]
        left[:, -1] = self.missing_left
        return np.where(self.feature[:, None] >= 0, 2 * node + 2 - left, node).reshape(-1)


@dataclass
class Booster:
    """Fitted trees by round and class."""

    classes: int
    n_features: int
    cuts: list[np.ndarray]
    settings: Settings
    rounds: list[list[Tree]] = field(default_factory=list)

    @property
    def margins(self) -> int:
        return 1 if self.classes == 2 else self.classes

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Rows x margins of feature values; NaN is missing."""
        return _added(self.rounds, x, np.isnan(x), False, np.zeros((len(x), self.margins)))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _probabilities(self.scores(x))

    def importances(self) -> np.ndarray:
        """Share of each feature in the gain of all cuts."""
        total = np.zeros(self.n_features)
        for tree in (t for trees in self.rounds for t in trees):
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return total / total.sum() if total.sum() else total


def _added(rounds: list[list[Tree]], x: np.ndarray, missing: np.ndarray | int, binned: bool, out: np.ndarray) -> np.ndarray:
    for trees in rounds:
        for k, tree in enumerate(trees):
            out[:, k] += tree.value[tree.leaves(x, missing, binned)]
    return out


def _probabilities(margin: np.ndarray) -> np.ndarray:
    if margin.shape[1] == 1:
        p = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        return np.hstack([1 - p, p])
    e = np.exp(margin - margin.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def slopes(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope and curvature of the loss in each margin, in whole units."""
    p = _probabilities(margin)
    if margin.shape[1] == 1:
        g, h = p[:, 1:] - label[:, None], p[:, :1] * p[:, 1:]
    else:
        g, h = p - (label[:, None] == np.arange(p.shape[1])), 2 * p * (1 - p)
    return np.rint(g * UNIT), np.rint(np.maximum(h, 1e-6) * UNIT)


def taken(key: np.ndarray, round_: int, settings: Settings) -> np.ndarray:
    """Which rows the round learns from."""
    if settings.subsample >= 1:
        return np.ones(len(key), bool)
    x = key.astype(np.uint64) ^ np.uint64((settings.seed * 0x9E3779B97F4A7C15 + (round_ + 1) * 0xD1342543DE82EF95) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(settings.subsample * 2**64)


# ---------------------------------------------------------------- binned rows


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)


def feature_cuts(rows: DataFrame, d: int, bins: int) -> list[np.ndarray]:
    """Per feature the upper values of its bins, at even quantiles of the values that are there; one pass."""
    at = [i / bins for i in range(1, bins)]
    found = rows.select(F.posexplode("x").alias("feature", "v")).where("v IS NOT NULL AND NOT isnan(v)").groupBy("feature").agg(F.percentile_approx("v", at, 10_000).alias("cuts"))
    cuts = [np.zeros(0)] * d
    for r in found.collect():  # one row a feature
        cuts[r.feature] = np.unique(np.array(r.cuts))
    return cuts


# A batch of rows: keys, labels, bins (features x rows) and scores (margins x rows).
_BINNED = "key binary, y binary, bins binary, margin binary"
_BINNED_NAMES = ["key", "y", "bins", "margin"]


def _binned(cuts: list[np.ndarray], margins: int):
    missing = max(map(len, cuts), default=0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["x"], len(cuts))
            bins = np.empty(x.T.shape, np.uint8)
            for f, c in enumerate(cuts):
                bins[f] = np.where(np.isnan(x[:, f]), missing, np.searchsorted(c, x[:, f], "left"))
            if len(x):
                yield _packed(batch["key"].to_numpy(), batch["y"].to_numpy(), bins, np.zeros((margins, len(x))))

    return run


def _packed(*arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], _BINNED_NAMES)


def _unpacked(batches: Iterator[pa.RecordBatch], d: int, margins: int) -> Iterator[tuple]:
    """Keys, labels, bins and scores of each batch of rows; scores may be changed."""
    for batch in batches:
        for row in zip(*(batch[c] for c in _BINNED_NAMES), strict=True):
            key, y, bins, margin = (np.frombuffer(v.as_buffer(), t) for v, t in zip(row, (np.int64, np.int32, np.uint8, np.float64), strict=True))
            yield key, y, bins.reshape(d, len(key)), margin.reshape(margins, len(key)).copy()


def _renewed(booster: Booster, recent: list[list[Tree]]):
    """The rows with the scores of the recent rounds added."""
    d, margins, missing = booster.n_features, booster.margins, max(map(len, booster.cuts), default=0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, y, bins, margin in _unpacked(batches, d, margins):
            _added(recent, bins.T, missing, True, margin.T)
            yield _packed(key, y, bins, margin)

    return run


# ---------------------------------------------------------------- one level


_SUMS = "tree int, node int, block int, sums binary"
_SPLITS = "tree int, node int, g double, h double, gain double, feature int, bin int, missing_left boolean, gl double, hl double"
_SPLIT_NAMES = [c.split()[0] for c in _SPLITS.split(", ")]


def _level_sums(booster: Booster, recent: list[list[Tree]], growing: list[Tree], level: int, round_: int):
    """Slopes and curvatures of the partition's rows by (tree, node, feature, bin)."""
    # The trees of earlier rounds stay on the driver.
    d, margins, settings = booster.n_features, booster.margins, booster.settings
    width, nodes = max(map(len, booster.cuts), default=0) + 2, 1 << level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((margins, d, 2, nodes * width))
        for key, y, bins, margin in _unpacked(batches, d, margins):
            slope = [x.T for x in slopes(_added(recent, bins.T, width - 1, True, margin.T), y)]
            use = taken(key, round_, settings)
            for k, tree in enumerate(growing):
                node = tree.leaves(bins.T, width - 1, True, level) - (nodes - 1)
                mine = use & (node >= 0)
                own = bins
                g, h = (x[k] for x in slope)
                if not mine.all():
                    node, own, g, h = node[mine], bins[:, mine], g[mine], h[mine]
                at = node * width
                for f in range(d):
                    place = at + own[f]
                    sums[k, f, 0] += np.bincount(place, g, nodes * width)
                    sums[k, f, 1] += np.bincount(place, h, nodes * width)
        sums = sums.reshape(margins, d, 2, nodes, width)
        for k in range(margins):
            rows = []
            for node in np.flatnonzero(sums[k, 0, 1].sum(1)).tolist():
                for block, first in enumerate(range(0, d, BLOCK_FEATURES)):
                    part = sums[k, first : first + BLOCK_FEATURES, :, node].transpose(0, 2, 1).astype(np.int64)
                    rows.append((k, node, block, part.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["tree", "node", "block", "sums"])

    return run


def best_cut(sums: np.ndarray, settings: Settings) -> tuple:
    """(gain, feature, bin, missing left, slopes left, curvatures left) of the best cut of a node from its sums
    (features x bins x 2, the last bin holding missing values); of equal gains the first by feature, then by
    the side of missing values (right first) and bin. Gain 0 and feature -1 if none is allowed."""
    g, h = sums[:, :, 0] / UNIT, sums[:, :, 1] / UNIT
    g_all, h_all = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
    right = [np.cumsum(x[:, :-1], 1) for x in (g, h)]
    gl = np.stack([right[0], right[0] + g[:, -1:]], 1)
    hl = np.stack([right[1], right[1] + h[:, -1:]], 1)
    gr, hr = g_all[:, None] - gl, h_all[:, None] - hl
    l2 = settings.l2
    gain = (gl**2 / (hl + l2) + gr**2 / (hr + l2) - (g_all**2 / (h_all + l2))[:, None]) / 2 - settings.gain
    gain = np.where((hl >= settings.weight) & (hr >= settings.weight) & (gain > 1e-9), np.round(gain, 9), 0.0)
    f, side, b = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[f, side, b] <= 0:
        return 0.0, -1, 0, False, 0.0, 0.0
    return float(gain[f, side, b]), int(f), int(b), bool(side), float(gl[f, side, b]), float(hl[f, side, b])


def _splits(settings: Settings, d: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for *key, data in zip(*(batch[c].to_pylist() for c in ("tree", "node", "block", "sums")), strict=True):
                own = np.frombuffer(data, np.int64)
                total[tuple(key)] = total[tuple(key)] + own if tuple(key) in total else own
        rows = []
        for (tree, node, block), own in total.items():
            sums = own.reshape(-1, width, 2)
            gain, f, b, side, gl, hl = best_cut(sums, settings)
            g, h = (sums[0].sum(0) / UNIT).tolist()
            rows.append((tree, node, g, h, gain, f + block * BLOCK_FEATURES if f >= 0 else -1, b, side, gl, hl))
        if rows:
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], _SPLIT_NAMES)

    return run


def _grow(booster: Booster, rows: DataFrame, recent: list[list[Tree]], round_: int, tasks: int) -> list[Tree]:
    s, width = booster.settings, max(map(len, booster.cuts), default=0) + 2
    growing = [Tree(s.depth) for _ in range(booster.margins)]
    for level in range(s.depth):
        sums = rows.mapInArrow(_level_sums(booster, recent, growing, level, round_), _SUMS)
        keys = booster.margins * (1 << level) * math.ceil(booster.n_features / BLOCK_FEATURES)
        dealt = sums.repartition(min(tasks, keys), "tree", "node", "block") if tasks > 1 else sums.coalesce(1)
        best: dict[tuple, tuple] = {}
        for r in dealt.mapInArrow(_splits(s, booster.n_features, width), _SPLITS).collect():  # one row a tree, node and block
            old = best.get((r.tree, r.node))
            if old is None or (-r.gain, r.feature < 0, r.feature) < (-old.gain, old.feature < 0, old.feature):
                best[r.tree, r.node] = r
        for (k, local), r in best.items():
            tree, node = growing[k], local + (1 << level) - 1
            tree.value[node] = -s.eta * r.g / (r.h + s.l2)
            if r.feature < 0:
                continue
            tree.feature[node], tree.bin[node], tree.missing_left[node], tree.gain[node] = r.feature, r.bin, r.missing_left, r.gain
            cuts = booster.cuts[r.feature]
            tree.cut[node] = cuts[r.bin] if r.bin < len(cuts) else np.inf
            tree.value[2 * node + 1] = -s.eta * r.gl / (r.hl + s.l2)
            tree.value[2 * node + 2] = -s.eta * (r.g - r.gl) / (r.h - r.hl + s.l2)
        if not any(t.feature[(1 << level) - 1 : (1 << level + 1) - 1].max() >= 0 for t in growing):
            break
    return growing


# ---------------------------------------------------------------- fit and score


def _array(df: DataFrame, features: str):
    return F.col(features) if df.schema[features].dataType.typeName() == "array" else vector_to_array(features)


def fit(df: DataFrame, features: str = "features", label: str = "label", classes: int = 2, key: str | None = None, bins: int = BINS, **settings) -> Booster:
    """Learn from the rows that have a label (0 to classes - 1). `features` is a vector or an array of equal length in
    all rows, `key` the column whose hash decides on subsamples (the row's content by default)."""
    if not 2 <= bins <= 254:
        raise ValueError("2 to 254 bins")
    x = _array(df, features).cast("array<double>")
    by = F.xxhash64(F.col(key)) if key else F.xxhash64(F.to_json(F.struct(x.alias("x"), F.col(label).alias("y"))))
    rows = df.where(F.col(label).isNotNull()).select(by.alias("key"), F.col(label).cast("int").alias("y"), x.alias("x"))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("d"), F.max(F.size("x")).alias("most"), F.min("y").alias("low"), F.max("y").alias("high")).first()
    if not facts.n or facts.d != facts.most or facts.low < 0 or facts.high >= classes:
        raise ValueError("rows with features of one length and labels from 0 to classes - 1 are needed")
    booster = Booster(classes, facts.d, feature_cuts(rows, facts.d, bins), Settings(**settings))
    cores = df.sparkSession.sparkContext.defaultParallelism
    work = math.ceil(facts.n * booster.margins * (facts.d + WALK) / WORK_PER_TASK)
    tasks = max(math.ceil(facts.n / ROWS_PER_TASK), min(cores, work))
    if tasks <= cores:  # as many files as tasks
        rows = rows.repartition(tasks)
    table = written(rows.mapInArrow(_binned(booster.cuts, booster.margins), _BINNED), "binned")
    recent: list[list[Tree]] = []
    for round_ in range(booster.settings.rounds):
        trees = _grow(booster, table, recent, round_, tasks)
        booster.rounds.append(trees)
        recent = [*recent, trees]
        if len(recent) == KEPT_ROUNDS and round_ + 1 < booster.settings.rounds:
            table, recent = written(table.mapInArrow(_renewed(booster, recent), _BINNED), "binned"), []
    return booster


def scored(booster: Booster, df: DataFrame, features: str = "features") -> DataFrame:
    """Adds `p` and `pred`: for two classes the probability of class 1, else those of all classes; and the likelier class."""
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(booster))
    d, two = booster.n_features, booster.classes == 2

    @F.pandas_udf("array<double>")
    def probability(x: pd.Series) -> pd.Series:
        values = np.array([[np.nan if v is None else v for v in row] for row in x], float).reshape(-1, d)
        return pd.Series(list(pickle.loads(shared.value).probabilities(values)))

    out = df.withColumn("p", probability(_array(df, features).cast("array<double>")))
    likelier = F.array_position("p", F.array_max("p")).cast("int") - 1
    return out.withColumn("pred", likelier).withColumn("p", F.col("p")[1] if two else F.col("p"))
