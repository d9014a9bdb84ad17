import math

import numpy as np

from clickflow.llm import common, op9_graph_neardup as op

SCHEMA = "vec_id long, embedding array<float>, label int, node long"


def brute(rows, cosine=op.MIN_COSINE):
    ok = [i for i, (k, v) in enumerate(rows) if k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = {i: [] for i in range(len(rows))}
    unit = {i: np.float32(rows[i][1]).astype(float) / np.linalg.norm(np.float32(rows[i][1]).astype(float)) for i in ok}
    for i in ok:
        near[i] = [j for j in ok if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine]
    out = []
    for i, (k, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((k, len(near[i]), least, k == least))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    common.prepare(spark)
    df = spark.createDataFrame([(k, v, None, 3) for k, v in rows], SCHEMA)
    got = op.near_duplicates(df, **kw).collect()
    return sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in got], key=str), got


def test_awkward_vectors(spark):
    a, b = [1.0, 0.0, 0.5, 2.0], [1.0, 0.02, 0.5, 2.0]
    rows = [(1, a), (2, b), (3, a), (4, None), (5, []), (6, [0.0] * 4), (7, [1.0, None, 0.0, 0.0]), (8, [1.0, math.nan, 0.0, 0.0]),
            (9, [math.inf, 0.0, 0.0, 0.0]), (10, [-1.0, 0.0, -0.5, -2.0]), (11, [1e-30, 0.0, 5e-31, 2e-30]), (12, [1.0, 0.0]), (13, [1.0, 0.0]), (13, [1.0, 0.0])]
    assert run(spark, rows)[0] == brute(rows)


def test_null_ids_and_empty_table(spark):
    got = run(spark, [(None, [1.0, 0.0]), (1, [1.0, 0.0])])[0]
    assert sorted(got, key=str) == [(1, 0, 1, True), (None, 0, None, True)]
    assert run(spark, [])[0] == []


def test_shards_and_groups_against_brute_force(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(600, 24))
    x = np.concatenate([x, x[:60] + rnd.normal(size=(60, 24)) * 0.12, x[5] + rnd.normal(size=(150, 24)) * 0.1, x[7:8].repeat(40, axis=0)])
    rows = [(i, v) for i, v in enumerate(np.float32(x).tolist())]
    got, raw = run(spark, rows, shard=120, max_shard=300)
    want = brute(rows)
    found = {k: n for k, n, *_ in got}
    true = {k: n for k, n, *_ in want}
    assert all(found[k] <= true[k] for k in true)
    assert sum(found.values()) >= 0.9 * sum(true.values())
    # a figure of a sample of the same nodes (here all of them)
    assert abs(raw[0].audit_recall - sum(found.values()) / sum(true.values())) < 0.1
    comp = {k: c for k, _, c, _ in got}
    assert sum(comp[k] == c for k, _, c, _ in want) >= 0.97 * len(want)


def large_group(seed=8):
    """400 near vectors, nearly all pairs within the range, beside 60 others."""
    rnd = np.random.default_rng(seed)
    x = np.concatenate([rnd.normal(size=24) + rnd.normal(size=(400, 24)) * 0.15, rnd.normal(size=(60, 24))])
    return [(i, v) for i, v in enumerate(np.float32(x).tolist())]


def test_group_larger_than_a_shard(spark):
    rows = large_group()
    want = brute(rows)
    assert np.median([n for _, n, *_ in want]) > 300
    got, raw = run(spark, rows, shard=50, max_shard=100, block=60)
    assert got == want and raw[0].audit_recall == 1.0


def test_blocks_of_all_nodes_where_the_graph_finds_nothing(spark, monkeypatch):
    links = op.links
    monkeypatch.setattr(op, "links", lambda *a: links(*a[:2], 2.0, *a[3:]))
    rows = [*large_group(9), (900, [1.0, 0.0]), (901, [1.0, 0.01])]
    got, raw = run(spark, rows, shard=50, max_shard=100, block=60)
    assert got == brute(rows) and raw[0].audit_recall == 1.0


def test_pruned_lists_are_short_and_reachable():
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(400, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = op.shard_graph(x)
    assert near.shape == (400, 2 * op.DEGREE) and (near >= 0).any(axis=1).all()
    q, n = op.range_search(x, near, np.arange(400), 0.5)
    true = (x @ x.T >= 0.5).sum() - 400
    assert len(q) >= 0.9 * true
