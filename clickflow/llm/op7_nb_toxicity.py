"""Toxicity classifier: character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct character 3-, 4- and 5-grams of the lower-cased text (white
space runs are one space), hashed into ``BUCKETS``.  Over the training rows each bucket
gets its log-count ratio r = log((p/|p|) / (q/|q|)); the buckets whose ratio stands out
most against its standard error are kept, and a logistic regression with an L2 penalty
is fitted to the presence vectors multiplied by r.  Scoring is one gather from a
table of BUCKETS weights per document, whatever the corpus' size.

Training rows are a bounded sample: at most about ``MAX_LABELLED`` labelled rows, by
hash of doc_id, which is also what bounds the broadcast label table and the fit on the
driver (their selected buckets only).

Nulls and edges: a null or empty text has no n-grams and gets the intercept's score;
rows with a null label or doc_id don't train; if several labels share a doc_id the larger counts;
without labels of both classes every score is the share of label 1 with one row
of each class added; repeated rows score alike; an empty table gives no rows;
other columns are ignored (and kept by ``keep_rows``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import common

ORDERS = (3, 4, 5)
BITS = 18
BUCKETS = 1 << BITS
#: Bounds of the fit: labelled rows, kept buckets.
MAX_LABELLED, MAX_FEATURES = 20_000, 1_000
L2, STEPS, ALPHA = 1e-3, 150, 1.0
FOLDS, HELD_OUT = 5, 0
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])


def held_out(column: str = "doc_id", folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """crc32 of the id as text, modulo folds, is the fold left out (null id: false)."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == fold, F.lit(False))


class Grams:
    """Distinct buckets of a text's n-grams."""

    def __init__(self, orders: tuple[int, ...] = ORDERS, bits: int = BITS):
        self.orders, self.shift = orders, np.uint64(64 - bits)
        self.mark = np.zeros(1 << bits, dtype=np.int64)

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int64)
        chars = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        h, parts = chars + np.uint64(1), []
        for n in range(2, max(self.orders) + 1):
            if len(chars) < n:
                break
            h = h[:len(chars) - n + 1] * np.uint64(0x100000001B3) + chars[n - 1:] + np.uint64(1)
            if n in self.orders:
                parts.append((h * np.uint64(0x9E3779B97F4A7C15)) >> self.shift)
        if not parts:
            return np.zeros(0, dtype=np.int64)
        b = np.concatenate(parts).astype(np.int64)
        order = np.arange(len(b))
        self.mark[b] = order  # of equal buckets the last one stays
        return b[self.mark[b] == order]


class Model:
    """Weight of each bucket (already multiplied by r) and the intercept."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights.astype(np.float64), float(intercept)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        grams = self._grams = getattr(self, "_grams", None) or Grams()
        z = np.array([self.intercept + float(self.weights[grams(t)].sum()) for t in texts])
        return sigmoid(z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, width: int,
             l2: float = L2, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Penalised logistic regression by Nesterov's method on sparse rows."""
    n = len(y)
    w, b = np.zeros(width), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    size = np.bincount(rows, values ** 2, minlength=n)
    rate = 1 / (0.25 * max(np.percentile(size, 90), 1e-9) + l2)
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        z = np.bincount(rows, values * vw[cols], minlength=n) + vb
        err = (sigmoid(z) - y) / n
        gw = np.bincount(cols, values * err[rows], minlength=width) + l2 * vw
        step = min(rate * 4, 50.0)
        nw, nb = vw - step * gw, vb - step * err.sum()
        t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if (gw * (nw - w)).sum() > 0:
            t1 = 1.0  # restart: the momentum points uphill
        vw, vb = nw + (t - 1) / t1 * (nw - w), nb + (t - 1) / t1 * (nb - b)
        w, b, t = nw, nb, t1
    return w, b


def training_rows(docs: DataFrame, labels: DataFrame, label: str, train: Column, max_rows: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, y, text) of a bounded sample of the labelled rows outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & train))
    n = known.count()
    part = min(1.0, max_rows / max(n, 1))
    # by hash: the same rows however they are dealt
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(part * 1_000_000))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    # at most about max_rows rows of 12 bytes: bounded whatever the label table's size
    return common.text_rows(docs).join(F.broadcast(known), "doc_id").select("doc_id", "y", "text")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_LABELLED,
        max_features: int = MAX_FEATURES) -> Model:
    rows = training_rows(docs, labels, label, ~held_out(), max_rows)
    schema = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("grams", T.BinaryType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for b in common.parts(batches, 2):
            got = [grams(t).astype("<u4").tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1).cast(pa.int32()), pa.array(got, pa.binary())], names=schema.fieldNames())

    seen = common.written(rows.mapInArrow(common.tidied(extract), schema), "nb-grams")
    counted = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n0", T.LongType()), T.StructField("n1", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, BUCKETS), dtype=np.int64)
        for b in common.parts(batches, 1):
            for y, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n[y][np.frombuffer(g, dtype="<u4")] += 1
        at = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[0][at]), pa.array(n[1][at])], names=counted.fieldNames())

    classes = {r["y"]: r["count"] for r in seen.groupBy("y").count().collect()}
    if len(classes) < 2:
        ones, all_ = classes.get(1, 0) + 1, sum(classes.values()) + 2
        return Model(np.zeros(BUCKETS), np.log(ones / (all_ - ones)))
    per_bucket = seen.mapInArrow(common.tidied(count), counted).groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()  # at most BUCKETS rows
    n0, n1 = np.zeros(BUCKETS), np.zeros(BUCKETS)
    n0[per_bucket.bucket], n1[per_bucket.bucket] = per_bucket.n0, per_bucket.n1
    p, q = n1 + ALPHA, n0 + ALPHA
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    strength = np.abs(ratio) / np.sqrt(1 / p + 1 / q)
    strength[(n0 + n1) < 3] = 0
    chosen = np.sort(np.argsort(-strength, kind="stable")[:max_features])
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.parts(batches, 1):
            got = [place[np.frombuffer(g, dtype="<u4")] for g in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.sort(x[x >= 0]).astype("<u2").tobytes() for x in got], pa.binary())], names=schema.fieldNames())

    small = seen.mapInArrow(common.tidied(select), schema).toPandas()  # at most max_rows rows of max_features small ints
    small = small.sort_values(["y", "grams"], kind="stable")
    lists = [np.frombuffer(g, dtype="<u2").astype(np.int32) for g in small.grams]
    rows_, cols = np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate(lists)
    r = ratio[chosen]
    w, b = logistic(rows_, cols, r[cols], small.y.to_numpy(dtype=float), len(chosen))
    weights = np.zeros(BUCKETS)
    weights[chosen] = w * r
    return Model(weights, b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    def per_batch(keys: list, texts: list) -> Iterator[tuple]:
        yield keys, model.scores(texts)

    out = common.map_texts(common.text_rows(docs), per_batch, SCHEMA)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))


def keep_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that aren't predicted toxic, with all their columns."""
    model = fit(docs, labels)
    return common.filter_texts(docs, lambda texts: model.scores(texts) < 0.5)
