"""Training and scoring with Spark ML, and the linear forms that need no trainer."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, LogisticRegressionModel, OneVsRest, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from millrace.functions.numeric import dot
from millrace.operators import boosting, evaluate
from millrace.operators.boosting import Booster
from millrace.operators.relational import lookup_join
from millrace.session import scratch_path

# Configurations that are fitted side by side.
TOGETHER = 8


def assembled(df: DataFrame, features: Sequence[str], label: str, name: str = "features") -> DataFrame:
    """Adds the feature vector; rows with a missing feature are an error, impute first."""
    typed = df.withColumns({c: F.col(c).cast("double") for c in features}).withColumn("label", F.col(label).cast("double"))
    return VectorAssembler(inputCols=list(features), outputCol=name, handleInvalid="error").transform(typed)


def vector_column(df: DataFrame, array: str, name: str = "features") -> DataFrame:
    """Array column to an ML vector."""
    return df.withColumn(name, array_to_vector(F.col(array).cast("array<double>")))


def _stored(model: Model, kind: type, df: DataFrame) -> Model:
    """The model as it is read back from the shared folder: without the training summary, which holds on to the
    training table and would travel to the executors with every scoring expression."""
    path = scratch_path(df.sparkSession, "model")
    model.write().save(path)
    return kind.load(path)


def fit_logistic(df: DataFrame, max_iter: int = 1000, c: float = 1.0) -> Model:
    """L2 logistic regression with inverse strength `c` on the summed loss; Spark's
    penalty is per row, hence 1 / (n * c)."""
    n = df.count()
    return _stored(LogisticRegression(maxIter=max_iter, regParam=1.0 / (n * c), standardization=False).fit(df), LogisticRegressionModel, df)


def fit_forest(df: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42) -> Model:
    return _stored(RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(df), RandomForestClassificationModel, df)


def fit_boosted(df: DataFrame, rounds: int = 100, depth: int = 5, eta: float = 0.2, subsample: float = 0.8,
                seed: int = 42, key: str | None = None) -> Booster:
    """Boosted trees of second order for a 0/1 label."""
    return boosting.fit(df, rounds=rounds, depth=depth, eta=eta, subsample=subsample, seed=seed, key=key)


def fit_multiclass(df: DataFrame, rounds: int = 100, depth: int = 5, eta: float = 0.3, seed: int = 42, key: str | None = None) -> Booster:
    """Boosted trees of second order for labels 0 to n - 1: one booster, whose trees of all classes grow together (softmax)."""
    classes = int(df.agg(F.max("label")).first()[0]) + 1
    return boosting.fit(df, classes=max(classes, 2), rounds=rounds, depth=depth, eta=eta, seed=seed, key=key)


def fit_first_order(df: DataFrame, rounds: int = 100, depth: int = 5, eta: float = 0.2, subsample: float = 0.8,
                    seed: int = 42) -> Model:
    """Spark's boosted trees, which follow slopes only, for a 0/1 label."""
    return GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=eta, subsamplingRate=subsample, seed=seed).fit(df)


def fit_one_against_rest(df: DataFrame, rounds: int = 20, depth: int = 4, eta: float = 0.3, seed: int = 42,
                         parallelism: int = 4) -> Model:
    """Spark's boosted trees for many classes: one model per class against the rest."""
    one = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=eta, seed=seed)
    return OneVsRest(classifier=one, parallelism=parallelism).fit(df)


def scored(model: Model | Booster, df: DataFrame) -> DataFrame:
    """Adds `p` (probability of class 1) and `pred`; the vectors are dropped."""
    if isinstance(model, Booster):
        return boosting.scored(model, df)
    out = model.transform(df)
    return (
        out.withColumn("p", vector_to_array("probability")[1])
        .withColumn("pred", F.col("prediction").cast("int"))
        .drop("rawPrediction", "probability", "prediction")
    )


def scored_multiclass(model: Model | Booster, df: DataFrame) -> DataFrame:
    if isinstance(model, Booster):
        return boosting.scored(model, df).drop("p")
    out = model.transform(df)
    return out.withColumn("pred", F.col("prediction").cast("int")).drop("rawPrediction", "probability", "prediction")


def importances(model: Model | Booster, features: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, importance) of a tree model, one entry per feature."""
    values = model.importances() if isinstance(model, Booster) else model.featureImportances.toArray()
    return [(f, float(v)) for f, v in zip(features, values)]


def compare_variants(train: DataFrame, test: DataFrame, variants: Mapping[str, Mapping], fit=fit_boosted) -> DataFrame:
    """(variant, params, metrics, seconds) for each named configuration. Configurations go side by
    side, so that the small jobs of one fill the gaps of another; every fit and evaluation is a Spark job on persisted rows."""
    train, test = train.persist(), test.persist()

    def row(variant):
        (name, params), began = variant, time.monotonic()
        model = fit(train, **params)
        m = evaluate.binary_metrics(scored(model, test), "label", "pred").first()
        return name, str(dict(params)), m.accuracy, m.precision, m.recall, m.f1_score, m.samples_evaluated, time.monotonic() - began

    try:
        with ThreadPoolExecutor(TOGETHER) as pool:
            rows = list(pool.map(inheritable_thread_target(train.sparkSession)(row), variants.items()))
    finally:
        train.unpersist()
        test.unpersist()
    return train.sparkSession.createDataFrame(
        rows,
        "variant string, params string, accuracy double, precision double, recall double, f1_score double,"
        " samples_evaluated bigint, seconds double",
    )


# ---------------------------------------------------------- linear scoring


def centroids(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, weights): the mean vector per key."""
    cells = df.select(key, F.posexplode(vector).alias("pos", "x"))
    means = cells.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    # One entry per dimension: the list is as long as a vector, not as the data.
    return means.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("_w")).select(
        key, F.col("_w.m").alias("weights")
    )


def routed_scores(df: DataFrame, models: DataFrame, route: str, vector: str, intercept: str | None = None) -> DataFrame:
    """Each row scored by the linear model it names: one join and a dot product.
    Rows that name no known model get NULL."""
    joined = lookup_join(df, models, route)
    score = dot(F.col(vector), F.col("weights"))
    return joined.withColumn("score", score if intercept is None else score + F.col(intercept)).drop("weights")


def fit_linear_by_key(df: DataFrame, key: str, xs: Sequence[str], y: str, ridge: float = 1e-9) -> DataFrame:
    """(key, n, weights): least squares with intercept (first weight), one model per
    key. Spark computes means and covariances, so a key's rows are never brought together and
    large offsets do not cancel; only the small centred system per key is solved in Python.
    `ridge` is relative to the variances; a constant feature gets weight 0."""
    cols = [F.col(x).cast("double") for x in xs]
    d, target = len(cols), F.col(y).cast("double")
    known = df.dropna(subset=[*xs, y])
    sums = known.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in [*cols, target]]).alias("_mean"),
        F.array(*[F.covar_pop(a, b) for a in cols for b in cols]).alias("_xx"),
        F.array(*[F.covar_pop(a, target) for a in cols]).alias("_xy"),
    )

    @F.pandas_udf("array<double>")
    def solve(mean: pd.Series, xx: pd.Series, xy: pd.Series) -> pd.Series:
        out = []
        for m, a, b in zip(mean, xx, xy):
            a, b = np.reshape(np.asarray(a, float), (d, d)), np.asarray(b, float)
            size = np.sqrt(np.diag(a))
            size[size == 0] = 1.0  # a constant feature
            scaled = a / size[:, None] / size
            w = np.linalg.solve(scaled + ridge * np.eye(d) + np.diag(np.diag(scaled) == 0), b / size) / size
            out.append([float(m[-1] - w @ np.asarray(m[:-1])), *w.tolist()])
        return pd.Series(out)

    return sums.select(key, "n", solve("_mean", "_xx", "_xy").alias("weights"))
