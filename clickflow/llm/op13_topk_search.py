"""Exact top-k inner products by norm-bucketed retrieval.

Components become integers, floor(scale * x), so products are exact.  Vectors are grouped
by length: class c holds the lengths from RATIO^c up to RATIO^(c+1), at most some 15,000
classes for all double lengths, and a class with more than ``BUCKET_ROWS`` rows is dealt to
several buckets by a hash of the id.  The stated queries are dealt to blocks of about
``QUERY_ROWS``.

1. The ``SEED_ROWS`` longest vectors give each query a first k-th best score, a lower bound
   of its threshold.
2. A query goes only to buckets whose length bound times its own length reaches the
   threshold (longest first; below that no product can).  A bucket meets the blocks of
   queries sent to it by an equal-key cogroup, one bounded cell of bucket and block at a time.
3. In a cell the threshold over both lengths is the cosine that a vector must reach (the
   local threshold).  From a sample of the cell's queries the bucket gets a switch: queries
   with a local threshold from there on use coordinate pruning (a vector's coordinate
   along each of a query's ``FOCUS`` largest axes must lie within the angle that the
   threshold leaves; the sorted axis with the fewest vectors is read), the others length
   pruning (vectors sorted by length, down to the least that can reach the threshold).
4. What remains is verified by its exact product; a cell returns its k best per query, and
   the k best of those, ties to the smaller id, are the result.

Bounds are widened by a relative 1e-9, so rounding never prunes a vector; equal scores
are never pruned, so ties are right.  Products are taken in single precision where the
lengths prove every partial sum below 2^24, in double precision below 2^53, with Python
integers beyond (there scores are cut to the range of a long).

Nulls and edges: rows with a null id, a null vector, or null or non-finite components take
no part; vectors of different dimension have no product; a zero or empty vector scores 0; rows that
share an id count as one vector whose score is the best of its rows, and a query's own id
is never its answer; fewer than k others give fewer rows; no queries give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import common

RATIO = 1.05
#: Rows of a bucket and queries of a block, aimed at.
BUCKET_ROWS, QUERY_ROWS = 32_768, 8_192
#: Longest vectors that give the first thresholds (sent to every task).
SEED_ROWS = 1024
#: Queries of a cell that decide its switch, share of a bucket that coordinate pruning must come under, axes looked at.
SAMPLE, COORDINATE_SHARE, FOCUS = 64, 0.25, 3
#: Queries multiplied at a time.
CHUNK = 256
SLACK = 1e-9
ZERO_CLASS = -1

VECTORS = "vec_id long, dim int, norm double, class int, vec binary"
QUERIES = "block int, class int, sub int, vec_id long, dim int, norm double, threshold double, vec binary"
BUCKETS = "block int, class int, sub int, vec_id long, dim int, norm double, vec binary"
FOUND = "query_id long, vec_id long, score long"


def lengths(v: np.ndarray) -> np.ndarray:
    """Row lengths without overflow."""
    if not v.shape[1]:
        return np.zeros(len(v))
    top = np.abs(v).max(axis=1)
    safe = np.where(top > 0, top, 1.0)
    with np.errstate(over="ignore"):
        return np.minimum(top * np.sqrt(((v / safe[:, None]) ** 2).sum(axis=1)), np.finfo(float).max)


def pack(v: np.ndarray) -> list[bytes]:
    """Rows of whole numbers as two-byte integers, or as doubles where those don't do."""
    small = (np.abs(v) < 32768).all(axis=1) if v.shape[1] else np.ones(len(v), dtype=bool)
    short = np.where(small[:, None], v, 0).astype("<i2")
    wide = v.astype("<f8")
    return [short[i].tobytes() if s else wide[i].tobytes() for i, s in enumerate(small.tolist())]


def unpack(rows: list[bytes], dim: int) -> np.ndarray:
    """The rows as doubles."""
    if dim == 0:
        return np.zeros((len(rows), 0))
    if all(len(r) == 2 * dim for r in rows):
        return np.frombuffer(b"".join(rows), dtype="<i2").reshape(-1, dim).astype(float)
    return np.array([np.frombuffer(r, dtype="<i2" if len(r) == 2 * dim else "<f8").astype(float) for r in rows])


def length_class(norm: np.ndarray) -> np.ndarray:
    return np.where(norm > 0, np.floor(np.log(np.maximum(norm, 1.0)) / math.log(RATIO)), ZERO_CLASS).astype(np.int32)


def class_bound(c: int) -> float:
    """No vector of the class is longer."""
    exponent = (c + 1) * math.log(RATIO)
    return 0.0 if c == ZERO_CLASS else math.exp(min(exponent, 709.7)) * (1 + SLACK)


def mixed(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def whole_vectors(df: DataFrame, scale: float) -> DataFrame:
    """VECTORS of the rows that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            lists = b.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.values.to_numpy(zero_copy_only=False).astype(float)  # null components are NaN
            starts = lists.offsets.to_numpy()[:-1]
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                v = values[starts[at][:, None] + np.arange(dim)]
                fine = np.isfinite(v).all(axis=1)
                at = at[fine]
                if len(at) == 0:
                    continue
                with np.errstate(over="ignore"):
                    v = np.clip(np.floor(scale * v[fine]), -np.finfo(float).max, np.finfo(float).max)
                norm = lengths(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at], pa.int64()), pa.array(np.full(len(at), dim, dtype=np.int32)), pa.array(norm),
                     pa.array(length_class(norm)), pa.array(pack(v), pa.binary())], names=["vec_id", "dim", "norm", "class", "vec"])

    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where("vec_id is not null and embedding is not null").mapInArrow(run, VECTORS)


def products(q: np.ndarray, c: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of whole-number rows, as exact doubles or Python integers; `bound` is
    the product of the greatest lengths."""
    if bound < 1 << 24:
        return (q.astype(np.float32) @ c.astype(np.float32).T).astype(float)
    if bound < 1 << 53:
        return q @ c.T
    a, b = ([[int(x) for x in r] for r in m] for m in (q, c))
    top = (1 << 63) - 1
    out = np.empty((len(a), len(b)), dtype=object)
    for i, r in enumerate(a):
        out[i] = [max(-top - 1, min(top, sum(x * y for x, y in zip(r, s)))) for s in b]
    return out


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k greatest scores, ties to the smaller id; one row an id."""
    ok = ids != own
    scores, ids = scores[ok], ids[ok]
    if len(ids) > 4 * k and scores.dtype != object:
        # equal ids may take several places, so a few more than k are kept, and all ties
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        if len(np.unique(ids[keep])) >= k:
            scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores)) if scores.dtype != object else np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), dtype=int)
    _, first = np.unique(ids[order], return_index=True)
    order = order[np.sort(first)][:k]
    return ids[order], scores[order]


def seeded(vectors: np.ndarray, norms: np.ndarray, ids: np.ndarray, seeds: dict, k: int) -> np.ndarray:
    """A lower bound of each query's k-th best score."""
    out = np.full(len(ids), -np.inf)
    seed = seeds.get(vectors.shape[1])
    if seed is None or not len(ids):
        return out
    s_ids, s_vec, s_norm = seed
    for lo in range(0, len(ids), CHUNK):
        got = products(vectors[lo:lo + CHUNK], s_vec, norms[lo:lo + CHUNK].max() * s_norm.max())
        for i, row in enumerate(got, lo):
            _, scores = best(row, s_ids, ids[i], k)
            if len(scores) == k:
                out[i] = float(scores[-1])
    return np.where(np.abs(out) < 1 << 53, out, out - np.abs(out) * SLACK)


class Bucket:
    """Vectors of one cell and dimension, longest first."""

    def __init__(self, ids: np.ndarray, norms: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, -norms))
        self.ids, self.norms, self.vectors = ids[order], norms[order], vectors[order]
        self.longest = float(self.norms[0]) * (1 + SLACK)
        self._axes: dict[int, tuple] = {}
        self.unit = self.vectors / np.where(self.norms > 0, self.norms, 1.0)[:, None]

    def axis(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """(order, coordinates) of the unit vectors along axis f."""
        if f not in self._axes:
            order = np.argsort(self.unit[:, f], kind="stable")
            self._axes[f] = order, self.unit[order, f]
        return self._axes[f]

    def ranges(self, q: np.ndarray, cosine: float) -> list[tuple[int, int, int, float, float]]:
        """(count, axis, first, low, high) of the vectors that may reach the local threshold, for
        each of the unit query's largest axes, fewest first."""
        out, left = [], math.acos(min(1.0, cosine))
        for f in np.argsort(-np.abs(q))[:FOCUS].tolist():
            angle = math.acos(max(-1.0, min(1.0, float(q[f]))))
            low, high = math.cos(min(math.pi, angle + left)) - SLACK, math.cos(max(0.0, angle - left)) + SLACK
            _, along = self.axis(f)
            a, b = np.searchsorted(along, low, "left"), np.searchsorted(along, high, "right")
            out.append((int(b - a), f, int(a), low, high))
        return sorted(out)

    def switch(self, units: np.ndarray, cosines: np.ndarray) -> float:
        """The local threshold from which on coordinate pruning pays."""
        pick = np.flatnonzero((cosines > 0) & (cosines <= 1))
        if len(pick) == 0 or self.vectors.shape[1] == 0:
            return math.inf
        pick = pick[np.argsort(-cosines[pick], kind="stable")]
        pick = pick[np.linspace(0, len(pick) - 1, min(SAMPLE, len(pick))).astype(int)]
        at, share = math.inf, 0.0
        for n, i in enumerate(pick.tolist(), 1):
            share += self.ranges(units[i], float(cosines[i]))[0][0] / len(self.ids)
            if share / n > COORDINATE_SHARE:
                break
            at = float(cosines[i])
        return at

    def by_coordinates(self, q: np.ndarray, cosine: float) -> np.ndarray:
        (count, f, first, _, _), *others = self.ranges(q, cosine)
        at = self.axis(f)[0][first:first + count]
        for _, g, _, low, high in others:
            along = self.unit[at, g]
            at = at[(along >= low) & (along <= high)]
        return at


def search_cell(queries: pa.Table, bucket: pa.Table, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores): the k best of a bucket for each query of a block."""
    q_dims, c_dims = (t["dim"].to_numpy() for t in (queries, bucket))
    for dim in np.intersect1d(q_dims, c_dims).tolist():
        q, c = queries.filter(pa.array(q_dims == dim)), bucket.filter(pa.array(c_dims == dim))
        b = Bucket(c["vec_id"].to_numpy(), c["norm"].to_numpy(), unpack(c["vec"].to_pylist(), dim))
        ids, norms, thresholds = (q[x].to_numpy() for x in ("vec_id", "norm", "threshold"))
        vectors = unpack(q["vec"].to_pylist(), dim)
        units = vectors / np.where(norms > 0, norms, 1.0)[:, None]
        reach = norms * b.longest * (1 + SLACK)
        with np.errstate(divide="ignore", invalid="ignore"):
            cosines = np.where(reach > 0, thresholds * (1 - np.sign(thresholds) * SLACK) / reach, np.where(thresholds <= 0, -np.inf, np.inf))
        switch = b.switch(units, cosines)
        dense = np.flatnonzero(cosines < min(switch, 1 + SLACK))
        for i in np.flatnonzero((cosines >= switch) & (cosines <= 1 + SLACK)).tolist():
            at = b.by_coordinates(units[i], float(cosines[i]))
            if len(at):
                got = products(vectors[i:i + 1], b.vectors[at], norms[i] * b.longest)[0]
                at, got = at[got >= thresholds[i]], got[got >= thresholds[i]]
                yield int(ids[i]), *best(got, b.ids[at], ids[i], k)
        # length pruning: the vectors long enough for the least demanding query of a chunk
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(thresholds > 0, thresholds / (norms * (1 + SLACK)), 0.0) * (1 - SLACK)
        dense = dense[np.argsort(least[dense], kind="stable")]
        for lo in range(0, len(dense), CHUNK):
            part = dense[lo:lo + CHUNK]
            n = int(np.searchsorted(-b.norms, -least[part[0]], "right"))
            if n == 0:
                continue
            got = products(vectors[part], b.vectors[:n], norms[part].max() * b.longest)
            for i, row in zip(part.tolist(), got):
                yield int(ids[i]), *best(row, b.ids[:n], ids[i], k)


def search(base: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, bucket_rows: int = BUCKET_ROWS,
           query_rows: int = QUERY_ROWS, seed_rows: int = SEED_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` the k rows of `base` with
    the greatest products, its own id left out.  Both have vec_id and embedding."""
    base = common.written(whole_vectors(base, scale), "search-vectors")
    asked = common.written(whole_vectors(queries, scale), "search-queries")
    n_blocks = max(1, -(-asked.count() // query_rows))
    # at most one row a length class
    sizes = {r["class"]: max(1, -(-r["n"] // bucket_rows)) for r in base.groupBy("class").agg(F.count("*").alias("n")).collect()}
    first = base.orderBy(F.desc("norm"), "vec_id").limit(seed_rows).collect()
    seeds = {}
    for dim in {r["dim"] for r in first}:
        of = [r for r in first if r["dim"] == dim]
        seeds[dim] = np.array([r["vec_id"] for r in of]), unpack([bytes(r["vec"]) for r in of], dim), np.array([r["norm"] for r in of])
    bounds = sorted(((c, class_bound(c), n) for c, n in sizes.items()), reverse=True)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once for every bucket that its threshold reaches."""
        limits = np.array([x[1] for x in bounds])
        for b in batches:
            for dim in np.unique(b.column("dim").to_numpy()).tolist():
                part = b.filter(pa.array(b.column("dim").to_numpy() == dim))
                ids, norms = part.column("vec_id").to_numpy(), part.column("norm").to_numpy()
                vectors = part.column("vec").to_pylist()
                least = seeded(unpack(vectors, dim), norms, ids, seeds, k)
                block = (mixed(ids) % np.uint64(n_blocks)).astype(np.int32)
                for (c, bound, n), _ in zip(bounds, limits):
                    at = np.flatnonzero(norms * bound * (1 + SLACK) >= least)
                    if len(at):
                        for sub in range(n):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(block[at]), pa.array(np.full(len(at), c, np.int32)), pa.array(np.full(len(at), sub, np.int32)),
                                 pa.array(ids[at]), pa.array(np.full(len(at), dim, np.int32)), pa.array(norms[at]), pa.array(least[at]),
                                 part.column("vec").take(pa.array(at))], names=[x.split()[0] for x in QUERIES.split(", ")])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector in its bucket, once for every block of queries."""
        for b in batches:
            ids, classes = b.column("vec_id").to_numpy(), b.column("class").to_numpy()
            n = np.array([sizes[c] for c in classes.tolist()], dtype=np.uint64)
            # other bits of the hash than the block of a query with this id
            sub = ((mixed(ids) >> np.uint64(20)) % n).astype(np.int32) if len(ids) else np.zeros(0, np.int32)
            for block in range(n_blocks):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), block, np.int32)), b.column("class"), pa.array(sub), *(b.column(x) for x in ("vec_id", "dim", "norm", "vec"))],
                    names=[x.split()[0] for x in BUCKETS.split(", ")])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = list(search_cell(left, right, k)) if left.num_rows and right.num_rows else []
        return pa.table({"query_id": pa.array([q for q, ids, _ in rows for _ in ids], pa.int64()),
                         "vec_id": pa.array([int(i) for _, ids, _ in rows for i in ids], pa.int64()),
                         "score": pa.array([int(s) for _, _, scores in rows for s in scores], pa.int64())})

    cell = ["block", "class", "sub"]
    found = asked.mapInArrow(sent, QUERIES).groupBy(*cell).cogroup(base.mapInArrow(dealt, BUCKETS).groupBy(*cell)).applyInArrow(meet, FOUND)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top5(embeddings: DataFrame) -> DataFrame:
    """Every vector whose id is divisible by 50, against all others."""
    return search(embeddings, embeddings.where("vec_id % 50 = 0"))


#: The same, stated in DuckDB SQL.
SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_inner_product(q.v, c.v) AS BIGINT)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0 GROUP BY ALL),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
