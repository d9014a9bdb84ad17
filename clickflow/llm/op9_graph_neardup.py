"""Near-duplicate vectors on a robust-pruned flat graph.

Equal vectors are one node.  Nodes are dealt to overlapping cluster shards (nearest
centroids of a k-means fitted to a bounded sample; shards that are too large are split
again the same way).  In each shard every node gets a short adjacency list: its nearest
nodes and a few spread ones, robust-pruned (a candidate is left out when a closer kept
neighbour is nearer to it by the factor ``ALPHA``), with reverse edges.  The lists of
a node's shards are united.  Then each node is searched in its home shard: a greedy beam
search from the shard's medoid and the node itself, widened over all nodes within the
range until no new one turns up.  Every link is verified by its cosine in double
precision; united edges that leave the home shard are links too when their cosine says
so.  A shard's links become stars, whose components are the groups.

A link joins two nodes of one group, also where the group outgrows a shard.  So links are
counted inside the groups: their nodes are dealt to blocks of about ``BLOCK`` (small groups
share one, a large group has blocks in each home shard), and all pairs of a large group's
blocks that can hold a link, by the angle of their centers and their radii, are compared
exactly.  A block is one row, and a pair's links are summed per node where they are found.

Recall is audited in each run: a bounded sample of nodes is compared with all nodes by
brute force, and if under ``TARGET`` of their links were found, the shards are built
again with more overlap.  If that doesn't do either, the blocks of all nodes are compared
as if they were one group, which finds every link.  The figure is the column
``audit_recall``.

Nulls and edges: vectors that are null, empty, zero, or hold null or non-finite components
link with nothing, nor do rows with a null vec_id; vectors of different lengths never
link; rows that share a vec_id are rows of their own; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import common
from .components import components

MIN_COSINE = 0.95
#: Bounds of the index: rows that centroids are fitted on (for each shard that is split), centroids
#: of a split, nodes of a shard aimed at and at most.
FIT_ROWS, MAX_CENTROIDS, SHARD, MAX_SHARD = 16_000, 128, 3000, 8000
OVERLAP, DEEPER_OVERLAP, MORE_OVERLAP = 3, 2, 6
#: Candidates, spread candidates and degree of a node, pruning factor, beam width and steps.
NEAREST, SPREAD, DEGREE, ALPHA, BEAM = 48, 16, 24, 1.2, 24
#: Nodes this far under the least cosine are still widened from.
SLACK = 0.02
AUDIT_ROWS, TARGET = 400, 0.97
#: Nodes of a block in which links are counted.
BLOCK = 2000

MEMBERS = T.StructType([
    T.StructField("shard", T.StringType()), T.StructField("node", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("home", T.BooleanType()), T.StructField("vec", T.ArrayType(T.DoubleType()))])
LISTS = T.StructType([T.StructField("node", T.LongType()), T.StructField("near", T.ArrayType(T.LongType())),
                      T.StructField("linked", T.ArrayType(T.LongType())), T.StructField("linked_n", T.ArrayType(T.LongType()))])
FOUND = T.StructType([T.StructField("node", T.LongType()), T.StructField("root", T.LongType()),
                      T.StructField("n_links", T.LongType()), T.StructField("outside", T.ArrayType(T.LongType())),
                      T.StructField("shard", T.StringType())])
PACKED = T.StructType([
    T.StructField("block", T.StringType()), T.StructField("whole", T.LongType()), T.StructField("center", T.ArrayType(T.DoubleType())),
    T.StructField("radius", T.DoubleType()), T.StructField("node", T.BinaryType()), T.StructField("n", T.BinaryType()),
    T.StructField("root", T.BinaryType()), T.StructField("vec", T.BinaryType())])
COUNTED = T.StructType([T.StructField("node", T.LongType()), T.StructField("n_links", T.LongType()), T.StructField("root", T.LongType())])


def unit_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, vec): valid vectors scaled to length one, in double precision."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(fine)
    # scaled by the largest component first: no overflow, and a tiny vector keeps its direction
    top = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    rows = rows.withColumn("top", top).where("top > 0").withColumn("v", F.transform("v", lambda x: x / F.col("top") + 0.0))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return rows.withColumn("norm", norm).select("vec_id", F.transform("v", lambda x: x / F.col("norm")).alias("vec"))


def centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means."""
    rnd = np.random.default_rng(seed)
    c = x[np.sort(rnd.choice(len(x), min(k, len(x)), replace=False))]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 1e-12, total / np.maximum(size, 1e-12), c)
    return c


def split(members: DataFrame, overlap: int, shard: int, max_shard: int) -> DataFrame:
    """MEMBERS with the shards above `max_shard` nodes dealt to clusters of their own."""
    sizes = members.groupBy("shard").agg(F.count("*").alias("size")).where(F.col("size") > max_shard)
    sizes = common.written(sizes, "graph-sizes")
    if not sizes.head(1):
        return members
    part = F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < (FIT_ROWS / F.col("size")) * 1_000_000
    fitted = T.StructType([T.StructField("shard", T.StringType()), T.StructField("centers", T.BinaryType()), T.StructField("width", T.IntegerType())])

    def fit(f: pd.DataFrame) -> pd.DataFrame:
        x = np.array(f.sort_values("node").vec.tolist())
        c = centroids(x, int(min(MAX_CENTROIDS, max(2, -(-f["size"].iloc[0] * overlap // shard)))))
        return pd.DataFrame({"shard": [f["shard"].iloc[0]], "centers": [c.tobytes()], "width": [x.shape[1]]})

    # at most about FIT_ROWS rows of each shard
    sample = members.join(sizes, "shard").where(part).select("shard", "node", "size", "vec")
    fit_of = common.written(sample.groupBy("shard").applyInPandas(fit, fitted), "graph-centers")
    names = MEMBERS.fieldNames()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = b.to_pandas()
            for path, g in f.groupby("shard", sort=False):
                c = np.frombuffer(g.centers.iloc[0]).reshape(-1, g.width.iloc[0])
                x = np.array(g.vec.tolist())
                order = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :overlap]
                for r in range(order.shape[1]):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f"{path}/{j}" for j in order[:, r].tolist()]), pa.array(g.node.to_numpy()), pa.array(g.n.to_numpy()),
                        pa.array(g.home.to_numpy() & (r == 0)), pa.array(g.vec.tolist(), pa.list_(pa.float64()))], names=names)

    small = members.join(sizes.select("shard"), "shard", "left_anti")
    large = members.join(fit_of, "shard").select(*names, "centers", "width").mapInArrow(deal, MEMBERS)
    return common.written(small.select(*names).unionByName(large), "graph-members")


def pruned(x: np.ndarray, at: np.ndarray, cand: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Robust pruning of candidate lists (positions, -1: none): shape (len(at), degree)."""
    sims = np.einsum("ncd,nd->nc", x[cand], x[at])
    sims[(cand < 0) | (cand == at[:, None])] = -9
    order = np.argsort(-sims, axis=1, kind="stable")
    cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
    alive = sims > -9
    alive[:, 1:] &= cand[:, 1:] != cand[:, :-1]
    to_x = np.sqrt(np.maximum(2 - 2 * sims, 0))
    v = x[cand]
    between = np.sqrt(np.maximum(2 - 2 * np.einsum("nid,njd->nij", v, v), 0))
    out = np.full((len(at), degree), -1, dtype=np.int64)
    used = np.zeros(len(at), dtype=np.int64)
    for i in range(cand.shape[1]):
        take = alive[:, i] & (used < degree)
        out[take, used[take]] = cand[take, i]
        used[take] += 1
        gone = alpha * between[:, i, :] <= to_x
        gone[:, :i + 1] = False
        alive &= ~(gone & take[:, None])
    return out


def shard_graph(x: np.ndarray, seed: int = 11, block: int = 250) -> np.ndarray:
    """Adjacency (positions, -1: none) of a shard's nodes: pruned lists and reverse edges."""
    n = len(x)
    rnd = np.random.default_rng(seed)
    k = min(NEAREST + 1, n)
    out = np.full((n, DEGREE), -1, dtype=np.int64)
    low = x.astype(np.float32)
    for lo in range(0, n, block):
        at = np.arange(lo, min(lo + block, n))
        s = low[at] @ low.T
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        cand = np.concatenate([near, rnd.integers(0, n, (len(at), SPREAD))], axis=1)
        out[at] = pruned(x, at, cand)
    # of the reverse edges each node keeps the nearest DEGREE
    u, slot = np.nonzero(out >= 0)
    v = out[u, slot]
    sims = np.einsum("ed,ed->e", low[u], low[v]) if len(u) else np.zeros(0)
    order = np.lexsort((-sims, v))
    u, v = u[order], v[order]
    rank = np.arange(len(v)) - np.searchsorted(v, v, side="left")
    back = np.full((n, DEGREE), -1, dtype=np.int64)
    ok = rank < DEGREE
    back[v[ok], rank[ok]] = u[ok]
    return np.concatenate([out, back], axis=1)


def matrix(f: pd.DataFrame) -> np.ndarray:
    return np.array(f.vec.tolist(), dtype=np.float64)


def by_width(f: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Vectors of different lengths don't meet."""
    for _, g in f.groupby(f.vec.map(len), sort=True):
        yield g.sort_values("node").reset_index(drop=True)


def build(f: pd.DataFrame, cosine: float) -> pd.DataFrame:
    rows = []
    for g in by_width(f):
        x, node, n = matrix(g), g.node.to_numpy(), g.n.to_numpy()
        near = shard_graph(x)
        for lo in range(0, len(x), 1000):
            part = near[lo:lo + 1000]
            sims = np.einsum("ncd,nd->nc", x[part], x[lo:lo + 1000])
            for i, (row, s) in enumerate(zip(part, sims), lo):
                ok = (row >= 0) & (row != i)
                ids = np.unique(row[ok])
                hit = np.unique(row[ok & (s >= cosine)])
                rows.append((node[i], node[ids].tolist(), node[hit].tolist(), n[hit].tolist()))
    return pd.DataFrame(rows, columns=LISTS.fieldNames())


def range_search(x: np.ndarray, near: np.ndarray, queries: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(query number, position) of the nodes found with at least that cosine."""
    q, n = len(queries), len(x)
    seen = np.zeros((q, n), dtype=bool)
    medoid = int((x @ x.mean(axis=0)).argmax())
    each = np.arange(q)

    def sims_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a))
        for lo in range(0, len(a), 100_000):
            out[lo:lo + 100_000] = np.einsum("ed,ed->e", x[queries[a[lo:lo + 100_000]]], x[b[lo:lo + 100_000]])
        return out

    beam = np.full((q, BEAM), -1, dtype=np.int64)
    score = np.full((q, BEAM), -9.0)
    done = np.zeros((q, BEAM), dtype=bool)
    beam[:, 0], beam[:, 1] = medoid, queries
    beam[queries == medoid, 1] = -1
    for c in (0, 1):
        ok = beam[:, c] >= 0
        score[ok, c] = sims_of(each[ok], beam[ok, c])
        seen[each[ok], beam[ok, c]] = True
    hits_q, hits_n = [], []
    wide = cosine - SLACK

    def visit(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unseen neighbours of the (query, node) pairs, with their cosines."""
        to = near[b]
        qq, nn = np.repeat(a, to.shape[1]), to.ravel()
        ok = nn >= 0
        code = np.unique(qq[ok] * n + nn[ok])
        qq, nn = code // n, code % n
        new = ~seen[qq, nn]
        qq, nn = qq[new], nn[new]
        seen[qq, nn] = True
        return qq, nn, sims_of(qq, nn)

    def note(qq: np.ndarray, nn: np.ndarray, s: np.ndarray) -> None:
        near_by = s >= wide
        hits_q.append(qq[near_by])
        hits_n.append(nn[near_by])

    note(each, np.full(q, medoid), sims_of(each, np.full(q, medoid)))
    note(each, queries, np.ones(q))
    # greedy: the best node of each beam that hasn't been opened
    while True:
        open_ = np.where(done | (beam < 0), -9.0, score)
        best = open_.argmax(axis=1)
        go = open_[each, best] > -9
        if not go.any():
            break
        done[each[go], best[go]] = True
        qq, nn, s = visit(each[go], beam[each[go], best[go]])
        if not len(qq):
            continue
        note(qq, nn, s)
        # new nodes, widest rows first, merged into the beams
        first = np.searchsorted(qq, qq, side="left")
        slot = np.arange(len(qq)) - first
        width = int(slot.max()) + 1
        more, more_s = np.full((q, width), -1, dtype=np.int64), np.full((q, width), -9.0)
        more[qq, slot], more_s[qq, slot] = nn, s
        all_b, all_s = np.concatenate([beam, more], 1), np.concatenate([score, more_s], 1)
        all_d = np.concatenate([done, np.zeros_like(more, dtype=bool)], 1)
        top = np.argpartition(-all_s, BEAM - 1, axis=1)[:, :BEAM]
        beam, score, done = (np.take_along_axis(v, top, 1) for v in (all_b, all_s, all_d))
    # widening: from all nodes near the range to their neighbours, until none is new
    fq, fn = np.concatenate(hits_q), np.concatenate(hits_n)
    code = np.unique(fq * n + fn)
    fq, fn = code // n, code % n
    all_q, all_n = [fq], [fn]
    while len(fq):
        nq, nn_ = [], []
        for lo in range(0, len(fq), 20_000):
            qq, nn, s = visit(fq[lo:lo + 20_000], fn[lo:lo + 20_000])
            nq.append(qq[s >= wide])
            nn_.append(nn[s >= wide])
        fq, fn = np.concatenate(nq), np.concatenate(nn_)
        all_q.append(fq)
        all_n.append(fn)
    aq, an = np.concatenate(all_q), np.concatenate(all_n)
    ok = (sims_of(aq, an) >= cosine) & (queries[aq] != an)
    return aq[ok], an[ok]


def least_reachable(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Least label that each position reaches over the links (a, b)."""
    while len(a):
        old = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == old).all():
            break
    return label


def search(f: pd.DataFrame, cosine: float, block: int = 500) -> pd.DataFrame:
    rows = []
    for g in by_width(f):
        x, node, n = matrix(g), g.node.to_numpy(), g.n.to_numpy()
        lists = [np.searchsorted(node, ids) for ids in (np.asarray(v, dtype=np.int64) for v in g.near)]
        inside = [p[(p < len(node)) & (node[np.minimum(p, len(node) - 1)] == ids)] for p, ids in zip(lists, (np.asarray(v, dtype=np.int64) for v in g.near))]
        near = np.full((len(g), max(1, max(map(len, inside)))), -1, dtype=np.int64)
        for i, p in enumerate(inside):
            near[i, :len(p)] = p
        home = np.flatnonzero(g.home.to_numpy())
        label, count = np.arange(len(g)), np.zeros(len(g), dtype=np.int64)
        a, b = [], []
        for lo in range(0, len(home), block):
            q = home[lo:lo + block]
            qi, pos = range_search(x, near, q, cosine)
            np.add.at(count, q[qi], n[pos])
            a.append(q[qi])
            b.append(pos)
        a, b = (np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for v in (a, b))
        label = least_reachable(a, b, label)  # inside the shard
        is_home = g.home.to_numpy()
        for i, (ids, sizes) in enumerate(zip(g.linked, g.linked_n)):
            out, extra = [], 0
            if is_home[i] and len(ids):
                ids, sizes = np.asarray(ids, dtype=np.int64), np.asarray(sizes, dtype=np.int64)
                p = np.searchsorted(node, ids)
                away = (p == len(node)) | (node[np.minimum(p, len(node) - 1)] != ids)
                out, extra = ids[away].tolist(), int(sizes[away].sum())
            if is_home[i] or label[i] != i:
                rows.append((node[i], node[label[i]], int(count[i]) + extra if is_home[i] else None, out, g.shard[0]))
    out = pd.DataFrame(rows, columns=FOUND.fieldNames())
    return out.astype({"n_links": "Int64"})


def links(nodes: DataFrame, overlap: int, cosine: float, shard: int, max_shard: int) -> DataFrame:
    """FOUND of each node (and of its overlapping places in other shards)."""
    members = nodes.select(F.size("vec").cast("string").alias("shard"), "node", "n", F.lit(True).alias("home"), "vec")
    for level in range(6):
        wider = split(members, overlap if level == 0 else DEEPER_OVERLAP, shard, max_shard)
        if wider is members:
            break
        members = wider
    # a shard is bounded by max_shard unless six levels didn't part its nodes
    lists = common.written(members.groupBy("shard").applyInPandas(lambda f: build(f, cosine), LISTS), "graph-lists")
    pair = F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("linked", "linked_n"))))
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), pair.alias("p"))
    united = common.written(united.select("node", "near", F.col("p.linked").alias("linked"), F.col("p.linked_n").alias("linked_n")), "graph-united")
    rows = members.join(united, "node")
    return common.written(rows.groupBy("shard").applyInPandas(lambda f: search(f, cosine), FOUND), "graph-found")


def pack(f: pd.DataFrame) -> pd.DataFrame:
    """The nodes of a block as one row, with their center and greatest angle to it."""
    g = f.sort_values("node")
    x = matrix(g)
    center = x.mean(axis=0)
    size = np.linalg.norm(center)
    # without a direction nothing is bounded
    center, radius = (center / size, np.arccos(np.clip(x @ center / size, -1, 1)).max()) if size > 1e-9 else (x[0], np.pi)
    held = [g[c].to_numpy(dtype=np.int64).tobytes() for c in ("node", "n", "root")]
    return pd.DataFrame([(g.block.iloc[0], g.whole.iloc[0], center.tolist(), float(radius), *held, x.tobytes())], columns=PACKED.fieldNames())


def compare(f: pd.DataFrame, cosine: float, rows: int = 500) -> pd.DataFrame:
    """COUNTED of the nodes of a pair of blocks: links between them, in one group."""
    r = f.iloc[0]
    (node, n, root), (node_b, n_b, root_b) = ([np.frombuffer(r[c + e], dtype=np.int64) for c in ("node", "n", "root")] for e in ("", "_b"))
    x, y = np.frombuffer(r["vec"]).reshape(len(node), -1), np.frombuffer(r["vec_b"]).reshape(len(node_b), -1)
    same = r["block"] == r["block_b"]
    count, count_b = np.zeros(len(node), dtype=np.int64), np.zeros(len(node_b), dtype=np.int64)
    label = np.arange(len(node) + len(node_b))
    for lo in range(0, len(node), rows):
        at = slice(lo, lo + rows)
        hit = (x[at] @ y.T >= cosine) & (root[at, None] == root_b)
        if same:
            hit &= node[at, None] != node_b
        count[at] = hit @ n_b
        if not same:
            count_b += hit.T @ n[at]
        a, b = np.nonzero(hit)
        label = least_reachable(a + lo, b + (0 if same else len(node)), label)
    every = np.concatenate([node, node_b])
    out = pd.DataFrame({"node": every, "n_links": np.concatenate([count, count_b]), "root": every[label]})
    return out[:len(node)] if same else out


def counted(members: DataFrame, cosine: float, block: int) -> DataFrame:
    """COUNTED of `members` (node, n, vec, root, shard): links inside each root's group,
    and a node that it reaches in each pair of blocks."""
    width = F.size("vec")
    sizes = members.groupBy("root").agg(F.count("*").alias("size")).where("size > 1")
    sizes = common.written(sizes, "graph-groups")
    small = sizes.where(F.col("size") <= block).agg(F.sum("size")).first()[0] or 0
    parts = members.join(sizes, "root").groupBy("root", "shard").agg(F.count("*").alias("in_shard"))
    rows = members.join(sizes, "root").join(common.written(parts, "graph-parts"), ["root", "shard"])
    bucket = F.concat_ws("/", F.lit("small"), width, F.pmod(F.xxhash64("root"), F.lit(-(-small // block) or 1)))
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("in_shard") / block))
    large = F.col("size") > block
    rows = rows.select("node", "n", "vec", "root", F.when(large, F.concat_ws("/", F.lit("large"), "root", "shard", salt)).otherwise(bucket).alias("block"),
                       F.when(large, F.col("root")).alias("whole"))
    blocks = common.written(rows.groupBy("block").applyInPandas(pack, PACKED), "graph-blocks")
    one = blocks.select("block", "whole", "center", "radius")
    two = one.select(F.col("block").alias("block_b"), "whole", F.col("center").alias("center_b"), F.col("radius").alias("radius_b"))
    dot = F.aggregate(F.zip_with("center", "center_b", lambda p, q: p * q), F.lit(0.0), lambda a, v: a + v)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
    reach = F.col("radius") + F.col("radius_b") + float(np.arccos(cosine)) + 1e-6
    pairs = one.join(two, "whole").where((F.col("block") < F.col("block_b")) & (apart <= reach)).select("block", "block_b")
    pairs = common.written(pairs.unionByName(one.select("block", F.col("block").alias("block_b"))), "graph-pairs")
    held = ["node", "n", "root", "vec"]
    other = blocks.select(F.col("block").alias("block_b"), *(F.col(c).alias(c + "_b") for c in held))
    both = pairs.join(blocks.select("block", *held), "block").join(other, "block_b")
    # one group of rows a pair, so that a batch holds two blocks
    return common.written(both.groupBy("block", "block_b").applyInPandas(lambda f: compare(f, cosine), COUNTED), "graph-counted")


def grouped(nodes: DataFrame, overlap: int, cosine: float, shard: int, max_shard: int, block: int) -> DataFrame:
    """(node, root, n_links) of each node."""
    found = links(nodes, overlap, cosine, shard, max_shard)
    edges = found.select("node", F.col("root").alias("other")).unionByName(found.select("node", F.explode("outside").alias("other")))
    comp = common.written(components(edges, "node", "other", "node", "root"), "graph-components")
    home = found.where("n_links is not null").select("node", "shard")
    members = common.written(nodes.select("node", "n", "vec").join(home, "node").join(comp, "node", "left")
                             .withColumn("root", F.coalesce("root", "node")), "graph-grouped")
    counts = counted(members, cosine, block).groupBy("node").agg(F.sum("n_links").alias("n_links"))
    each = members.select("node", "root").join(counts, "node", "left").select("node", "root", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return common.written(each, "graph-links")


def compared(nodes: DataFrame, cosine: float, block: int) -> DataFrame:
    """(node, root, n_links) of each node, from all pairs of blocks that can hold links."""
    members = nodes.select("node", "n", "vec", F.size("vec").cast("long").alias("root"), F.lit("").alias("shard"))
    found = counted(members, cosine, block)
    comp = common.written(components(found.select("node", F.col("root").alias("other")), "node", "other", "node", "root"), "graph-components")
    counts = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    each = nodes.select("node").join(comp, "node", "left").join(counts, "node", "left")
    return common.written(each.select("node", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "graph-links")


def audit(nodes: DataFrame, found: DataFrame, cosine: float, rows: int = AUDIT_ROWS) -> float:
    """Share of the links of a bounded sample of nodes that were found; the sample is
    compared with all nodes.  1 if it has no links."""
    total = nodes.count()
    part = min(1.0, rows / max(total, 1))
    sample = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 53)) < part * (1 << 53)).select("node", "vec").toPandas()  # about `rows` rows
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("true_links", T.LongType())])
    queries = {w: (g.node.to_numpy(), matrix(g)) for w, g in sample.groupby(sample.vec.map(len))} if len(sample) else {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = b.to_pandas()
            for w, g in f.groupby(f.vec.map(len)):
                if w in queries:
                    ids, q = queries[w]
                    hit = (q @ matrix(g).T >= cosine) & (ids[:, None] != g.node.to_numpy()[None, :])
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(hit @ g.n.to_numpy())], names=schema.fieldNames())

    true = nodes.select("node", "n", "vec").mapInArrow(count, schema).groupBy("node").agg(F.sum("true_links").alias("true_links"))
    both = true.where("true_links > 0").join(found.select("node", "n_links"), "node").agg(F.sum(F.least("n_links", "true_links")), F.sum("true_links")).first()
    return float(both[0] / both[1]) if both[1] else 1.0


def near_duplicates(df: DataFrame, cosine: float = MIN_COSINE, shard: int = SHARD, max_shard: int = MAX_SHARD, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, audit_recall."""
    units = common.written(unit_vectors(df), "graph-units")
    nodes = units.groupBy("vec").agg(F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
    nodes = common.written(nodes.withColumn("node", F.monotonically_increasing_id()), "graph-nodes")
    for overlap in (OVERLAP, MORE_OVERLAP):
        found = grouped(nodes, overlap, cosine, shard, max_shard, block)
        recall = audit(nodes, found, cosine)
        if recall >= TARGET:
            break
    else:
        found = compared(nodes, cosine, block)
        recall = audit(nodes, found, cosine)
    each = common.written(nodes.join(found, "node").select("vec", "n", "least_id", "root", "n_links"), "graph-each")
    least = each.groupBy("root").agg(F.min("least_id").alias("component_id"))
    each = each.join(least, "root").select("vec", (F.col("n_links") + F.col("n") - 1).alias("n_links"), "component_id")
    valid = units.join(each, "vec").select("vec_id", "n_links", "component_id")
    # the others link with nothing
    other = df.select(F.col("vec_id").cast("long").alias("vec_id")).groupBy("vec_id").agg(F.count("*").alias("rows"))
    of_valid = units.groupBy(F.col("vec_id").alias("id")).agg(F.count("*").alias("valid"))
    rest = other.join(of_valid, F.col("vec_id") == F.col("id"), "left").withColumn("rest", F.col("rows") - F.coalesce("valid", F.lit(0))).where("rest > 0")
    single = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.explode(F.sequence(F.lit(1), F.col("rest").cast("int"))).alias("_")).drop("_")
    out = valid.unionByName(single)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))).withColumn("audit_recall", F.lit(recall))
