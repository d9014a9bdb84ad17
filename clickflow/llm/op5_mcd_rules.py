"""Quality rules with robust multivariate outliers.

Base rules: a document fails with fewer than 10 words, or if over 20 % of its words lie
in 5-word windows that it has twice or more.  The others are judged by their transformed
statistics (``VECTOR``): per language and source, the minimum-covariance-determinant
estimate of centre and scatter is found by concentration steps from deterministic starts
(medians with scaled absolute deviations, and the moments of the half of the rows
nearest to them), and a document is rejected when its robust Mahalanobis distance
exceeds a chi-square quantile.

Each concentration step is two grouped aggregations over the small statistics table,
combined before the shuffle, so a source with a third of all rows costs no task more.
Estimates stay tables of one row per group.  A group with fewer than ``MIN_ROWS`` rows
uses its language's estimate, or else that of all rows.  ``FLOOR`` is the least standard
deviation of each coordinate: most documents have no symbol or repeated line at
all, and the estimate would otherwise be singular.

Nulls and edges: a null text has no words and fails; null languages and sources are a
group like others; repeated rows are judged alike; an empty table gives no rows; other
columns are ignored (and kept by ``keep_rows``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import common
from .text_stats import BASE, base_counts

MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Transformed statistics and the least standard deviation of each.
VECTOR = ("x_words", "x_length", "x_symbols", "x_dup_lines", "x_repeats")
FLOOR = (0.5, 0.25, 0.1, 0.1, 0.1)
#: Words that a document's rates are smoothed by, so that short texts don't stand out.
PRIOR_WORDS, PRIOR_LENGTH = 50.0, 5.0
#: Share of rows that the estimate rests on, steps, rows that a group needs, tail of the cut.
SHARE, STEPS, MIN_ROWS, TAIL = 0.75, 4, 60, 1e-7
P = len(VECTOR)
TERMS = [(i, j) for i in range(P) for j in range(i, P)]
NONE = "\x00"
STATS = T.StructType([T.StructField("doc_id", T.LongType())] + [T.StructField(c, T.LongType()) for c in BASE])


def chi2_quantile(q: float, p: int = P) -> float:
    """Wilson and Hilferty's approximation."""
    return p * (1 - 2 / (9 * p) + NormalDist().inv_cdf(q) * math.sqrt(2 / (9 * p))) ** 3


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def vector() -> dict[str, Column]:
    """VECTOR from the counts."""
    words = F.col("n_words") + PRIOR_WORDS
    return {"x_words": F.log(F.col("n_words") + 1.0),
            "x_length": (F.col("word_chars") + PRIOR_WORDS * PRIOR_LENGTH) / words,
            "x_symbols": F.sqrt(F.col("n_symbols") / words),
            "x_dup_lines": F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 5.0)),
            "x_repeats": F.sqrt(F.col("n_repeat_words") / words)}


def group_of(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(NONE)
    return F.coalesce(F.col(name).cast("string"), F.lit(NONE))


def statistics(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang_key, source_key, the counts."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("lang_key", "source_key")] + list(STATS))
    rows = docs.select(group_of(docs, "lang").alias("lang_key"), group_of(docs, "source").alias("source_key"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.parts(batches, 3):
            counts = np.array([base_counts(t) for t in b.column(3).to_pylist()], dtype=np.int64).reshape(-1, len(BASE))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *(pa.array(counts[:, i]) for i in range(len(BASE)))],
                                             names=schema.fieldNames())

    return rows.mapInArrow(common.tidied(run), schema).withColumn("base_failed", base_failed()).withColumns(vector())


def distance() -> Column:
    """Squared Mahalanobis distance of VECTOR from `center` with the matrix `inverse`."""
    diff = [F.col(c) - F.col("center")[i] for i, c in enumerate(VECTOR)]
    return sum((diff[i] * diff[j] * F.col("inverse")[i * P + j] * (1 if i == j else 2) for i, j in TERMS), F.lit(0.0))


ESTIMATE = T.StructType([
    T.StructField("lang_key", T.StringType()), T.StructField("source_key", T.StringType()),
    T.StructField("start", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("center", T.ArrayType(T.DoubleType())), T.StructField("inverse", T.ArrayType(T.DoubleType())),
    T.StructField("log_det", T.DoubleType())])


def solved(moments: DataFrame) -> DataFrame:
    """ESTIMATE from rows of (keys, start, n, shift, sums, products)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                m = max(r.n_used, 1)
                mean = np.array(r.sums) / m
                cov = np.zeros((P, P))
                for (i, j), v in zip(TERMS, r.products):
                    cov[i, j] = cov[j, i] = v / m - mean[i] * mean[j]
                # a variance below the floor is lifted to it
                cov[np.diag_indices(P)] = np.maximum(np.diag(cov), 0) + np.maximum(np.square(FLOOR) - np.diag(cov), 1e-4 * np.square(FLOOR))
                out.append((r.lang_key, r.source_key, r.start, r.n, (mean + np.array(r.shift)).tolist(),
                            np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
            yield pd.DataFrame(out, columns=ESTIMATE.fieldNames())

    return moments.mapInPandas(run, ESTIMATE)


KEYS = ["lang_key", "source_key"]


def moments(rows: DataFrame, used: Column) -> DataFrame:
    """Sums of the rows that `used` marks, around `shift`, by group and start."""
    diff = [F.col(c) - F.col("shift")[i] for i, c in enumerate(VECTOR)]
    pick = lambda c: F.sum(F.when(used, c).otherwise(0.0))
    return rows.groupBy(*KEYS, "start").agg(
        F.max("n").alias("n"), F.first("shift").alias("shift"), F.sum(used.cast("long")).alias("n_used"),
        F.array(*(pick(d) for d in diff)).alias("sums"),
        F.array(*(pick(diff[i] * diff[j]) for i, j in TERMS)).alias("products"))


def estimates(stats: DataFrame, share: float = SHARE, steps: int = STEPS, min_rows: int = MIN_ROWS) -> DataFrame:
    """Final estimate of each (language, source), (language) and of all rows with at
    least `min_rows` rows; ``cut_unit`` is the distance's scale under normality."""
    fit = stats.where(~F.col("base_failed")).select(*KEYS, *VECTOR)
    levels = F.explode(F.array(F.struct("lang_key", "source_key"), F.struct("lang_key", F.lit("*").alias("source_key")),
                               F.struct(F.lit("*").alias("lang_key"), F.lit("*").alias("source_key"))))
    rows = fit.select(levels.alias("key"), *VECTOR).select("key.lang_key", "key.source_key", *VECTOR)
    medians = rows.groupBy(*KEYS).agg(F.count("*").alias("n"), F.array(*(F.percentile_approx(c, 0.5) for c in VECTOR)).alias("shift"))
    medians = common.written(medians.where((F.col("n") >= min_rows) | (F.col("lang_key") == "*")), "mcd-medians")
    spread = rows.join(medians, KEYS).groupBy(*KEYS).agg(
        F.max("n").alias("n"), F.first("shift").alias("shift"),
        F.array(*(F.percentile_approx(F.abs(F.col(c) - F.col("shift")[i]), 0.5) for i, c in enumerate(VECTOR))).alias("mad"))
    scale = [F.greatest(1.4826 * F.col("mad")[i], F.lit(f)) for i, f in enumerate(FLOOR)]
    diagonal = F.array(*(1 / (scale[i] * scale[i]) if i == j else F.lit(0.0) for i in range(P) for j in range(P)))
    first = spread.select(*KEYS, F.lit(0).alias("start"), "n", F.col("shift").alias("center"), diagonal.alias("inverse"),
                          sum((2 * F.log(s) for s in scale), F.lit(0.0)).alias("log_det"))
    now = common.written(first, "mcd-start")

    def step(now: DataFrame, part: float) -> DataFrame:
        far = rows.join(now, KEYS).select(*KEYS, "start", "n", F.col("center").alias("shift"), *VECTOR, distance().alias("d2"))
        # written, so that its size is known: a few groups are broadcast, many are joined and split
        cut = common.written(far.groupBy(*KEYS, "start").agg(F.percentile_approx("d2", part).alias("cut")), "mcd-cut")
        return solved(moments(far.join(cut, [*KEYS, "start"]), F.col("d2") <= F.col("cut")))

    now = common.written(now.unionByName(step(now, 0.5).withColumn("start", F.lit(1))), "mcd-starts")
    for _ in range(steps):
        now = common.written(step(now, share), "mcd-step")
    best = now.groupBy(*KEYS).agg(F.min_by(F.struct("n", "center", "inverse"), F.struct("log_det", "start")).alias("e")).select(*KEYS, "e.*")
    best = common.written(best, "mcd-best")
    unit = rows.join(best, KEYS).select(*KEYS, distance().alias("d2")).groupBy(*KEYS).agg(F.percentile_approx("d2", share).alias("q"))
    # where over the share's rows lie closer than normal rows would, the cut stays
    return common.written(best.join(unit, KEYS).withColumn("cut_unit", F.greatest(F.col("q") / chi2_quantile(share), F.lit(1.0))), "mcd")


def judged(stats: DataFrame, est: DataFrame, tail: float = TAIL) -> DataFrame:
    """`stats` with distance2 and kept, under the nearest estimate there is."""
    e = est.select(*KEYS, F.struct("center", "inverse", "cut_unit").alias("e"))
    by_source = e.where((F.col("source_key") != "*") & (F.col("lang_key") != "*")).withColumnRenamed("e", "e_source")
    by_lang = e.where((F.col("source_key") == "*") & (F.col("lang_key") != "*")).select("lang_key", F.col("e").alias("e_lang"))
    of_all = e.where(F.col("lang_key") == "*").select(F.lit(1).alias("one"), F.col("e").alias("e_all"))
    rows = (stats.join(by_source, KEYS, "left").join(by_lang, "lang_key", "left")
            .withColumn("one", F.lit(1)).join(F.broadcast(of_all), "one", "left"))  # one row
    rows = rows.withColumn("e", F.coalesce("e_source", "e_lang", "e_all")).withColumns(
        {"center": F.col("e.center"), "inverse": F.col("e.inverse")})
    rows = rows.withColumn("distance2", F.when(~F.col("base_failed"), distance() / F.col("e.cut_unit")))
    far = F.coalesce(F.col("distance2") > chi2_quantile(1 - tail), F.lit(False))
    return rows.withColumn("kept", ~F.col("base_failed") & ~far).drop(
        "e", "e_source", "e_lang", "e_all", "one", "center", "inverse")


def rules(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, distance2 (null if base_failed), kept."""
    stats = common.written(statistics(docs), "mcd-stats")
    return judged(stats, estimates(stats)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance2", "kept")


def keep_rows(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns.  The statistics
    are made again beside the texts, so that no text is shuffled."""
    stats = common.written(statistics(docs).select(*KEYS, "base_failed", *VECTOR), "mcd-stats")
    est = estimates(stats)
    names = docs.columns
    held = [common.fresh_name(docs, f"counts_{i}") for i in range(len(BASE))]
    schema = T.StructType(list(docs.schema) + [T.StructField(c, T.LongType()) for c in held])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.parts(batches, "text"):
            counts = np.array([base_counts(t) for t in b.column("text").to_pylist()], dtype=np.int64).reshape(-1, len(BASE))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(counts[:, i]) for i in range(len(BASE)))], names=schema.fieldNames())

    rows = docs.mapInArrow(common.tidied(run), schema)
    whole = rows.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), *(F.col(h).alias(c) for h, c in zip(held, BASE)))
    lang, source = (F.coalesce(F.col("row")[c].cast("string"), F.lit(NONE)) if c in names else F.lit(NONE) for c in ("lang", "source"))
    whole = whole.withColumns({"lang_key": lang, "source_key": source, "base_failed": base_failed(), **vector()})
    return judged(whole, est).where("kept").select("row.*")
