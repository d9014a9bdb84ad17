"""Exact top-k search against brute force, where either kind of pruning decides."""

import duckdb
import numpy as np
import pyarrow as pa

from clickflow.llm import common, op13_topk_search as op

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>"


def brute(base, queries, k=5, scale=256):
    def whole(rows):
        return [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
                if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    base = whole(base)
    for q in {i for i, _ in whole(queries)}:
        scores = {}
        for _, a in [r for r in whole(queries) if r[0] == q]:
            for i, b in base:
                if i != q and len(a) == len(b):
                    s = sum(x * y for x, y in zip(a, b))
                    scores[i] = max(scores.get(i, s), s)
        top = sorted(scores.items(), key=lambda r: (-r[1], r[0]))[:k]
        out |= {(q, n, i, s) for n, (i, s) in enumerate(top, 1)}
    return out


def got(df):
    rows = [(r.query_id, r.rank, r.vec_id, r.score) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def check(spark, rows, ask=lambda i: i % 50 == 0, **kw):
    common.prepare(spark)
    df = spark.createDataFrame(rows, SCHEMA)
    queries = [r for r in rows if r[0] is not None and ask(r[0])]
    found = got(op.search(df, spark.createDataFrame(queries, SCHEMA), **kw))
    assert found == brute(rows, queries, kw.get("k", 5))
    return found


def unit(rng, n, d):
    v = rng.standard_normal((n, d))
    return v / np.linalg.norm(v, axis=1)[:, None]


def test_many_lengths_small_buckets_and_blocks(spark):
    rng = np.random.default_rng(1)
    v = unit(rng, 900, 8) * np.exp(rng.normal(0, 2, 900))[:, None]
    rows = [(int(i), x.tolist()) for i, x in enumerate(v)]
    check(spark, rows, lambda i: i % 20 == 0, bucket_rows=40, query_rows=10, seed_rows=30)


def test_one_length_and_close_groups(spark):
    rng = np.random.default_rng(2)
    centers = unit(rng, 12, 32)
    v = unit(rng, 1200, 32) * 0.05 + centers[rng.integers(0, 12, 1200)]
    v[100:500] = v[3]  # a third are equal: ties by id
    rows = [(int(i), x.tolist()) for i, x in enumerate(v / np.linalg.norm(v, axis=1)[:, None])]
    check(spark, rows, bucket_rows=100, query_rows=5)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.1, 0.2]), (0, [0.1, 0.2]), (50, [1.0, -1.0]), (50, [0.5, 3.0]), (1, [0.0, 0.0]), (2, []), (100, []), (3, None), (None, [1.0, 1.0]),
            (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [0.1, 0.2]), (8, [-0.001, 0.0]), (9, [1e30, -1e30]), (10, [3e38, 1.0]),
            (150, [1.0, 2.0, 3.0]), (11, [1.0, 2.0, 3.0]), (-50, [300.0, 200.0]), (12, [0.1, 0.2]), (12, [9.0, 9.0]), (13, [5000.0, 7000.0])]
    small = [r for r in rows if r[0] not in (9, 10)]
    check(spark, small)
    check(spark, small, k=1)
    # products beyond a long are cut to its range
    found = got(op.search(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows[:1], SCHEMA)))
    assert {r[1:] for r in found if r[1] == 1} == {(1, 10, (1 << 63) - 1)}


def test_empty_tables(spark):
    common.prepare(spark)
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(0, [1.0])], SCHEMA)
    for base, asked in ((none, none), (none, one), (one, none), (one, one)):
        assert got(op.search(base, asked)) == set()
    extra = one.selectExpr("*", "1 as class", "2 as norm", "'x' as vec", "3 as rank")
    assert got(op.search(extra.union(extra.withColumn("vec_id", extra.vec_id + 1)), extra)) == {(0, 1, 1, 65536)}


def test_both_kinds_of_pruning_are_used_and_right():
    rng = np.random.default_rng(4)
    v = np.floor(256 * unit(rng, 4000, 6))
    b = op.Bucket(np.arange(4000), op.lengths(v), v)
    q = v[:300]
    norms = op.lengths(q)
    scores = q @ v.T
    tight, loose = np.sort(scores, axis=1)[:, -5], np.full(300, 100.0)
    for thresholds, some in ((tight, True), (loose, False)):
        cosines = thresholds / (norms * b.longest)
        switch = b.switch(q / norms[:, None], cosines)
        assert (cosines >= switch).any() == some
    for i in range(300):
        at = b.by_coordinates(q[i] / norms[i], tight[i] / (norms[i] * b.longest))
        assert set(np.flatnonzero(scores[i] >= tight[i])) <= set(b.ids[at]) and len(at) < 2000
    table = pa.table({"vec_id": np.arange(4000), "dim": np.full(4000, 6), "norm": op.lengths(v), "vec": op.pack(v)})
    asked = table.slice(0, 300).append_column("threshold", pa.array(tight))
    for i, ids, found in op.search_cell(asked, table, 5):
        want = sorted((-scores[i, j], j) for j in range(4000) if j != i)[:5]
        kept = [(s, j) for s, j in want if -s >= tight[i]]
        assert [(-s, j) for s, j in zip(found, ids)][:len(kept)] == kept


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert got(op.top5(common.table(spark, SF, "embeddings"))) == set(con.execute(op.SQL).fetchall())
