"""Quality classifier: regularised quadratic discriminant over text statistics.

Each document becomes a short vector of transformed counts (``FEATURES``).  Per class the
mean and covariance are taken over all training rows by one grouped aggregation; the
covariance is shrunk towards the pooled one and then towards its own diagonal.  The score
is the posterior of class 1 under the two normal densities: the difference of log
densities, each from a Mahalanobis distance by the class's Cholesky factor, which is
computed once and cached.

Nulls and edges: a null or empty text has zero counts and is scored like any other;
rows with a null label or doc_id don't train; if several labels share a doc_id the larger
counts; without labels of both classes every score is the share of label 1
with one row of each class added; repeated rows score alike; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import common
from .op7_nb_toxicity import held_out, sigmoid
from .text_stats import DETAIL, detail_counts

FOLDS, HELD_OUT = 3, 1
#: Shrinkage towards the pooled covariance, towards the diagonal, and the least variance.
POOLED, DIAGONAL, LEAST = 0.05, 0.05, 1e-4
FEATURES = ("words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "punct", "distinct", "short", "marked", "lines")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType())] + [T.StructField(c, T.DoubleType()) for c in FEATURES])


def transform(counts: np.ndarray) -> np.ndarray:
    """FEATURES from the counts named in DETAIL."""
    c = dict(zip(DETAIL, counts.T.astype(float)))
    words, chars = c["n_words"] + 20.0, c["n_chars"] + 50.0
    return np.stack([
        np.log(c["n_words"] + 1), (c["word_chars"] + 100.0) / words, np.sqrt(c["n_symbols"] / words),
        np.sqrt(c["n_dup_lines"] / (c["n_lines"] + 20.0)), np.sqrt(c["n_repeat_words"] / words),
        np.sqrt(c["n_upper"] / chars), np.sqrt(c["n_digits"] / chars), np.sqrt(c["n_punct"] / chars),
        np.log(c["n_distinct_words"] + 2) / np.log(c["n_words"] + 2), c["n_short_words"] / words,
        np.sqrt(c["n_marked_words"] / words), np.log((c["n_lines"] + 1) / words)], axis=1)


class Density:
    """Normal log density with a cached Cholesky factor."""

    def __init__(self, mean: np.ndarray, cov: np.ndarray):
        self.mean, self.factor = mean, np.linalg.cholesky(cov)
        self.whiten = np.linalg.inv(self.factor)
        self.log_det = 2 * float(np.log(np.diag(self.factor)).sum())

    def log(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.whiten.T
        return -0.5 * ((z * z).sum(axis=1) + self.log_det)


class Model:
    def __init__(self, moments: dict[int, tuple[int, np.ndarray, np.ndarray]], pooled: float = POOLED, diagonal: float = DIAGONAL):
        """`moments`: count, mean and covariance of each class."""
        n1, n0 = (moments[y][0] if y in moments else 0 for y in (1, 0))
        self.prior = float(np.log((n1 + 1) / (n0 + 1)))
        self.classes: dict[int, Density] = {}
        if n0 and n1:
            both = (n0 * moments[0][2] + n1 * moments[1][2]) / (n0 + n1)
            for y, (_, mean, cov) in moments.items():
                s = (1 - pooled) * cov + pooled * both
                s = (1 - diagonal) * s + diagonal * np.diag(np.diag(s))
                self.classes[y] = Density(mean, s + LEAST * np.eye(len(s)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), sigmoid(np.array(self.prior)))
        return sigmoid(self.prior + self.classes[1].log(x) - self.classes[0].log(x))


def features(docs: DataFrame) -> DataFrame:
    """doc_id and FEATURES of each row."""
    def per_batch(keys: list, texts: list) -> Iterator[tuple]:
        x = transform(np.array([detail_counts(t) for t in texts], dtype=np.int64).reshape(-1, len(DETAIL)))
        yield keys, *x.T

    return common.map_texts(common.text_rows(docs), per_batch, SCHEMA)


def fit(rows: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Class moments over all labelled rows outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("doc_id", FOLDS, HELD_OUT))
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    pairs = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i:]]
    got = (rows.join(known, "doc_id").groupBy("y").agg(
        F.count("*").alias("n"), *(F.sum(a).alias(a) for a in FEATURES),
        *(F.sum(F.col(a) * F.col(b)).alias(f"{a}*{b}") for a, b in pairs)).collect())  # two rows
    moments = {}
    for r in got:
        n, mean = r["n"], np.array([r[a] for a in FEATURES]) / r["n"]
        cov = np.zeros((len(FEATURES),) * 2)
        for a, b in pairs:
            i, j = FEATURES.index(a), FEATURES.index(b)
            cov[i, j] = cov[j, i] = r[f"{a}*{b}"] / n - mean[i] * mean[j]
        moments[r["y"]] = (n, mean, cov)
    return Model(moments)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = common.written(features(docs), "rda-features")
    model = fit(rows, labels)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(FEATURES))], axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(x))], names=schema.fieldNames())

    return rows.mapInArrow(run, schema).select(
        "doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
