"""Language identification with a string kernel.

The blended-spectrum presence kernel counts the byte n-grams (n = 1, 2, 3; A-Z folded)
that two texts share, normalised by their own counts. Landmarks are training texts;
the grams of the landmarks are the vocabulary, so that a text's kernel values against
all landmarks are one product of its presence row with the landmarks' presence matrix,
taken for a batch of texts at a time. The Nystroem map of these values feeds one ridge
regression per language (one against the rest, classes weighted alike).

The training rows are a bounded sample: per language one row in each of
`SAMPLE / languages` hash cells of the id; `LANDMARKS` of them in all are landmarks.
Every text is classified as a whole.

Defined results: a null text, or one without a letter, is `und` with score 0; so is
every text if there is nothing to learn from. Ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, SPACE, crc_fold, share, slices, text_buffers

SAMPLE, LANDMARKS, VOCABULARY = 4096, 96, 60_000
RIDGE, SHARPNESS = 0.05, 4.0
UNDETERMINED = "und"
BATCH_ROWS = 256
HAS_LETTER = r"\p{L}"
_FOLD = LOWER.copy()
_FOLD[SPACE] = 32


def _codes(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3: the gram at each position as a number below 256**n, and its row."""
    c = _FOLD[data].astype(np.int32)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    out = [(1, c, row)]
    for n in (2, 3):
        if len(c) < n:
            break
        code = out[-1][1]
        whole = row[: len(c) - n + 1] == row[n - 1 :]
        out.append((n, (code[: len(c) - n + 1] * 256 + c[n - 1 :]), np.where(whole, row[: len(c) - n + 1], -1)))
    return out


def _distinct_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its distinct grams, coded as n * 2**24 + gram."""
    for batch in batches:
        data, offsets = text_buffers(batch["text"])
        grams = []
        for i in range(len(offsets) - 1):
            part = _codes(data[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
            grams.append(np.concatenate([np.unique(code) + (n << 24) for n, code, _ in part]) if offsets[i + 1] > offsets[i] else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(grams, pa.list_(pa.int64()))], ["grams"])


@dataclass
class Model:
    """Languages, the vocabulary, the landmarks' presence (vocabulary x landmarks) and the
    weights (landmarks x languages)."""

    languages: list[str]
    grams: np.ndarray
    presence: np.ndarray
    weights: np.ndarray | None = None
    bias: np.ndarray | None = None


def _kernel(model: Model):
    """A function from texts to their normalised kernel values against the landmarks."""
    size = len(model.grams) + 1
    tables = {n: np.zeros(256**n, np.uint16) for n in (1, 2, 3)}
    for n, table in tables.items():
        mine = np.flatnonzero(model.grams >> 24 == n)
        table[model.grams[mine] & 0xFFFFFF] = mine + 1
    presence = np.vstack([np.zeros((1, model.presence.shape[1]), np.float32), model.presence.astype(np.float32)])
    norm = np.sqrt(np.maximum(presence.sum(axis=0), 1))

    def values(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        flags = np.zeros((len(offsets) - 1, size), np.float32)
        flat = flags.reshape(-1)
        for n, code, row in _codes(data, offsets):
            gram = tables[n][code]
            hit = (gram > 0) & (row >= 0)
            flat[row[hit].astype(np.int64) * size + gram[hit]] = 1
        own = np.sqrt(np.maximum(flags.sum(axis=1, keepdims=True), 1))
        return flags @ presence / own / norm

    return values


def _batched(column, values) -> np.ndarray:
    data, offsets = text_buffers(column)
    parts = []
    for a, b in slices(offsets):
        for i in range(a, b, BATCH_ROWS):
            j = min(i + BATCH_ROWS, b)
            parts.append(values(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
    return np.concatenate(parts)


def fit(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model | None:
    """Learn from the rows where `train` holds that have a language and a letter; None if there are none."""
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.coalesce(F.col(text_col), F.lit("")).rlike(HAS_LETTER)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.xxhash64(F.col(text_col))).alias("h"))
    languages = sorted(r[0] for r in rows.select("lang").distinct().limit(sample).collect())
    if not languages:
        return None
    cells = max(1, sample // len(languages))
    picked = rows.select("lang", "h").groupBy("lang", F.pmod("h", F.lit(cells)).alias("cell")).agg(F.min("h").alias("h")).select("lang", "h", "cell")
    chosen = picked.toPandas().sort_values(["lang", "cell"])  # at most `sample` rows of three numbers
    nth = chosen.groupby("lang").cumcount()
    marks = chosen[nth < max(1, landmarks // len(languages))]
    spark = docs.sparkSession

    def texts(of) -> DataFrame:
        keys = spark.createDataFrame(of[["h"]].astype("int64"), "h long")
        return rows.join(F.broadcast(keys), "h").dropDuplicates(["h"])

    grams = [np.array(r[0], np.int64) for r in texts(marks).select("text").mapInArrow(_distinct_grams, "grams array<long>").collect()]
    found, shared = np.unique(np.concatenate(grams), return_counts=True)
    if len(found) > VOCABULARY:  # the most shared ones
        found = np.sort(found[np.argsort(-shared, kind="stable")[:VOCABULARY]])
    presence = np.stack([np.isin(found, g) for g in grams], axis=1).astype(np.uint8)
    model = Model(languages, found, presence)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = _kernel(model)
        for batch in batches:
            if batch.num_rows:
                k = _batched(batch["text"], values)
                yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(list(k), pa.list_(pa.float32()))], ["lang", "k"])

    train_rows = texts(chosen).select("lang", "text").repartition(spark.sparkContext.defaultParallelism).mapInArrow(run, "lang string, k array<float>").collect()
    k = np.array([r[1] for r in train_rows], np.float64)
    y = np.where(np.array([[r[0] == lang for lang in languages] for r in train_rows]), 1.0, -1.0)
    _solve(model, k, y)
    return model


def _solve(model: Model, k: np.ndarray, y: np.ndarray) -> None:
    """Weighted ridge regression on the Nystroem features of kernel rows `k`."""
    p = model.presence.astype(np.float64)
    norm = np.sqrt(np.maximum(p.sum(axis=0), 1))
    values, vectors = np.linalg.eigh(p.T @ p / norm[:, None] / norm)
    good = values > 1e-8 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    share = (y > 0).sum(axis=0)
    weight = np.array([1 / share[i] for i in (y > 0).argmax(axis=1)])[:, None]
    weight *= len(y) / weight.sum()
    x = k @ root
    mean, target = (weight * x).mean(axis=0), (weight * y).mean(axis=0)
    x = x - mean
    solved = np.linalg.solve(x.T @ (weight * x) + RIDGE * np.eye(x.shape[1]), x.T @ (weight * (y - target)))
    model.weights, model.bias = root @ solved, target - mean @ solved


def predict(docs: DataFrame, model: Model | None, keep: list[Column], text_col: str = "text") -> DataFrame:
    """The columns `keep`, then lang_pred and score."""
    letter = F.coalesce(F.col(text_col), F.lit("")).rlike(HAS_LETTER)
    if model is None:
        return docs.select(*keep, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = docs.select(*keep, F.when(letter, F.col(text_col)).alias("_text"))
    kept = rows.columns[:-1]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared()
        values = _kernel(m)
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = _batched(batch["_text"], values) @ m.weights + m.bias
            power = np.exp(SHARPNESS * (raw - raw.max(axis=1, keepdims=True)))
            power /= power.sum(axis=1, keepdims=True)
            best = power.argmax(axis=1)
            told = batch["_text"].is_valid().to_numpy(zero_copy_only=False)
            lang = np.where(told, np.array(m.languages, object)[best], UNDETERMINED)
            score = np.where(told, power[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(lang, pa.string()), pa.array(score)], [*kept, "lang_pred", "score"])

    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")


FOLDS, HELD_OUT = 4, 2


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = crc_fold(F.col("doc_id"), FOLDS)
    return predict(docs, fit(docs, fold != HELD_OUT), [F.col("doc_id"), (fold == HELD_OUT).alias("held_out")])
