"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text, taken for many texts at once with numpy:
densities of lexicon hits (plain and weighted), the share of hits near a second-person word and
the inverse distance to the nearest one, capitals and words in capitals, marks of exclamation and
question, other punctuation, words that mix letters with digits or inner symbols, and
stretched letters. The lexicon is learned: the words (A-Z folded, look-alike digits and symbols
read as letters, other punctuation dropped) that are more common in toxic documents than the rest
by the largest likelihood ratios; their weights are smoothed log odds. Spark ML fits the trees on the training rows and the
isotonic curve on a fold that the trees have not seen.

Learning uses a bounded sample: the labelled row with the least hash in each of `SAMPLE` cells; a lexicon
of at most `LEXICON` words. All documents are scored.

Defined results: null and empty texts have all features 0 and are scored like any text; labels
other than 0 and 1, and rows whose labels differ, count as toxic if one is 1; without rows
of both classes every score is the share of toxic rows (0 if none).
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, Words, crc_fold, slices, text_buffers
from millrace.session import written

SAMPLE, LEXICON = 40_000, 200
LEAST_DOCUMENTS, LEAST_RATIO = 4, 20.0
NEAR = 4  # words between a hit and a second-person word
TREES, DEPTH, STEP = 30, 3, 0.2
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
# Second-person words of the corpus languages.
SECOND_PERSON = "you your yours yourself ya ur du dich dir dein deine deinen deiner ihr euch euer sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro".split()
# Characters commonly written for letters.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
NAMES = ["hits", "weighted", "strongest", "near_second", "nearest", "second", "capitals", "shouted", "exclaimed", "punctuation", "mixed", "symbols_inside", "stretched", "length"]

_FOLD = LOWER.copy()
for _a, _b in LOOKALIKE.items():
    _FOLD[ord(_a)] = ord(_b)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_DROP = ~(_LETTER[_FOLD])  # neither a letter nor read as one
_PUNCT = np.zeros(256, bool)
_PUNCT[33:127] = True
_PUNCT &= ~(_LETTER | _DIGIT)


def folded(words: Words) -> np.ndarray:
    """Word hashes that do not see case, look-alikes and punctuation. An exclamation mark is
    a look-alike only where a letter or digit follows in its word."""
    if not len(words):
        return np.zeros(0, np.uint64)
    view = copy(words)
    view.data = words.data.copy()
    solid = np.where((_LETTER | _DIGIT)[words.data], np.arange(len(words.data)), -1)
    last = np.maximum.reduceat(solid, words.start)
    bang = np.flatnonzero(words.data == 33)
    bang = bang[bang > last[np.searchsorted(words.start, bang, "right") - 1]]
    view.data[bang] = 46
    return view.hashes(_FOLD, _DROP)


def _word_hashes(texts: list[str]) -> np.ndarray:
    data, offsets = text_buffers(pa.array(texts))
    return folded(Words(data, offsets))


def features(data: np.ndarray, offsets: np.ndarray, lexicon: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One row of NAMES per text; `lexicon` holds sorted word hashes."""
    words, n = Words(data, offsets), len(offsets) - 1
    out = np.zeros((n, len(NAMES)))
    if not len(words):
        return out
    hashes = folded(words)
    per = lambda x: np.bincount(words.row, weights=x, minlength=n)
    count = np.maximum(words.count, 1)
    place = np.minimum(np.searchsorted(lexicon, hashes), max(len(lexicon) - 1, 0))
    hit = (lexicon[place] == hashes) if len(lexicon) else np.zeros(len(words), bool)
    weight = np.where(hit, weights[place], 0.0) if len(lexicon) else np.zeros(len(words))
    second = np.isin(hashes, _word_hashes(SECOND_PERSON))
    index = np.arange(len(words))
    before = np.maximum.accumulate(np.where(second, index, -(10**9)))
    after = np.minimum.accumulate(np.where(second, index, 10**9)[::-1])[::-1]
    before = np.where(before >= words.bounds[words.row], index - before, 10**9)
    after = np.where(after < words.bounds[words.row + 1], after - index, 10**9)
    distance = np.minimum(before, after)
    hits = np.maximum(per(hit), 1)
    upper, letter, digit = (np.add.reduceat(t[data].astype(np.int32), words.start) for t in (_UPPER, _LETTER, _DIGIT))
    inner = np.append(0, np.cumsum(_PUNCT[data]))
    inside = inner[np.maximum(words.end - 1, words.start + 1)] - inner[words.start + 1]
    strongest = np.zeros(n)
    np.maximum.at(strongest, words.row, weight)
    same = np.zeros(len(data), bool)
    low = _FOLD[data]
    same[2:] = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & _LETTER[data[2:]] & (data[2:] < 128)
    byte = lambda t: np.diff(np.append(0, np.cumsum(t))[offsets])
    chars = np.maximum(byte(~words.space), 1)
    exclaimed = (data == 33) | (data == 63)
    columns = [
        per(hit) / count, per(weight) / count, strongest, per(hit & (distance <= NEAR)) / hits, per(np.where(hit, 1 / (1.0 + distance), 0)) / hits, per(second) / count,
        byte(_UPPER[data]) / chars, per((upper == letter) & (letter > 1)) / count, byte(exclaimed) / chars, byte(_PUNCT[data] & ~exclaimed) / chars,
        per((letter > 0) & (digit > 0)) / count, per((inside > 0) & (letter > 1)) / count, byte(same) / chars, np.log1p(words.count),
    ]
    return np.stack(columns, axis=1)


def _feature_rows(lexicon: np.ndarray, weights: np.ndarray, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["_text"])
            for a, b in slices(offsets):
                x = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lexicon, weights)
                yield pa.RecordBatch.from_arrays([*[batch[c].slice(a, b - a) for c in kept], *[pa.array(x[:, i]) for i in range(x.shape[1])]], [*kept, *NAMES])

    return run


def with_features(rows: DataFrame, lexicon: np.ndarray, weights: np.ndarray, keep: list[str]) -> DataFrame:
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, F.col("text").alias("_text")).mapInArrow(_feature_rows(lexicon, weights, keep), f"{kinds}, " + ", ".join(f"{c} double" for c in NAMES))


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch["text"])
        label = batch["toxic"].to_numpy()
        for a, b in slices(offsets):
            words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            if not len(words):
                continue
            every, row = _pairs(folded(words), words.row)
            word, first = np.unique(every, return_index=True)
            total = np.add.reduceat(np.ones(len(every), np.int64), first)
            toxic = np.add.reduceat(label[a:b][row].astype(np.int64), first)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(toxic), pa.array(total)], ["word", "toxic", "docs"])


def _pairs(word: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (word, row) pairs, by word."""
    order = np.lexsort((row, word))
    word, row = word[order], row[order]
    new = np.append(True, (word[1:] != word[:-1]) | (row[1:] != row[:-1]))
    return word[new], row[new]


def learn_lexicon(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes (sorted) and weights from rows (text, toxic)."""
    base = rows.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    bad, good = base[0] or 0, base[1] - (base[0] or 0)
    if not bad or not good:
        return np.zeros(0, np.uint64), np.zeros(0)
    counts = rows.select("text", "toxic").mapInArrow(_distinct_words, "word long, toxic long, docs long").groupBy("word").agg(F.sum("toxic").alias("a"), F.sum("docs").alias("docs"))
    # Dunning's log-likelihood ratio of the two-by-two table (word or not, toxic or not).
    n, part = bad + good, "coalesce({0} * ln({0} / nullif({1}, 0)), 0)"
    cells = [("a", f"docs * {bad}D / {n}"), ("(docs - a)", f"docs * {good}D / {n}"), (f"({bad} - a)", f"({n} - docs) * {bad}D / {n}"), (f"({good} - docs + a)", f"({n} - docs) * {good}D / {n}")]
    ratio = " + ".join(part.format(f"nullif({x}, 0)", e) for x, e in cells)
    rows = counts.where(F.col("docs") >= LEAST_DOCUMENTS).selectExpr(
        "word", f"2 * ({ratio}) AS ratio", f"ln((a + 0.5D) / ({bad} - a + 0.5D)) - ln((docs - a + 0.5D) / ({good} - docs + a + 0.5D)) AS odds")
    top = rows.where(f"odds > 0 AND ratio >= {LEAST_RATIO}").orderBy(F.desc("ratio"), "word").limit(LEXICON).select("word", "odds").collect()
    word = np.array([r[0] for r in top], np.int64).view(np.uint64)
    weight = np.array([r[1] for r in top], float)
    order = np.argsort(word)
    return word[order], weight[order]


def sample_rows(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> DataFrame:
    """At most `sample` labelled training rows (doc, text, toxic, fold)."""
    ids = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & train).groupBy(F.col(id_col).alias("doc")).agg(F.max((F.col(label_col) == 1).cast("int")).alias("toxic"))
    h = F.xxhash64("doc")
    ids = ids.groupBy(F.pmod(h, F.lit(sample))).agg(F.min_by(F.struct("doc", "toxic"), F.struct(h, F.col("doc"))).alias("r")).select("r.*")
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.join(F.broadcast(ids), "doc").withColumn("fold", crc_fold(F.col("doc"), FOLDS))


def scored(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per document: doc_id, the features, and score, learned from the labels where `train` (a
    condition on the id) holds."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = written(sample_rows(docs, labels, train, id_col, text_col, label_col), "labelled")
    lexicon, weights = learn_lexicon(known.where(F.col("fold") != CALIBRATION))
    spread = known.repartition(docs.sparkSession.sparkContext.defaultParallelism)
    learning = written(with_features(spread, lexicon, weights, ["toxic", "fold"]), "features")
    table = with_features(rows, lexicon, weights, ["doc_id"])
    classes = {r[0]: r[1] for r in learning.groupBy("toxic").count().collect()}
    folds = learning.groupBy((F.col("fold") == CALIBRATION).alias("c")).agg(F.countDistinct("toxic").alias("n")).collect()
    if len(classes) < 2 or sorted((r.c, r.n) for r in folds) != [(False, 2), (True, 2)]:
        return table.withColumn("score", F.lit(classes.get(1, 0) / max(sum(classes.values()), 1)))
    vector = VectorAssembler(inputCols=NAMES, outputCol="_x")
    learning = vector.transform(learning)
    trees = GBTClassifier(featuresCol="_x", labelCol="toxic", predictionCol="_p", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=1)
    model = trees.fit(learning.where(F.col("fold") != CALIBRATION))

    def raw(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("_margin", vector_to_array("probability")[1])

    curve = IsotonicRegression(featuresCol="_margin", labelCol="toxic", predictionCol="_score").fit(raw(learning.where(F.col("fold") == CALIBRATION)))
    fitted = curve.transform(raw(vector.transform(table)))
    # A little of the margin keeps rows apart within the steps of the curve.
    return fitted.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.98 * F.col("_score") + 0.02 * F.col("_margin")))).select("doc_id", *NAMES, "score")


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = scored(docs, labels, crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    return out.select("doc_id", (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("hits").alias("lexicon_density"))
