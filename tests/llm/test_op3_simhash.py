import re
from itertools import combinations

import numpy as np
import xxhash

from clickflow.llm import common, op3_golay_simhash as op
from helpers import awkward_docs, empty_docs, sentence


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_components(prints):
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, j in combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 4:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(prints))]


def test_every_pair_within_four_bits_shares_a_bucket():
    rnd = np.random.default_rng(3)
    a = rnd.integers(0, 1 << 64, 3000, dtype=np.uint64)
    flips = np.zeros(3000, dtype=np.uint64)
    for i in range(3000):
        for b in rnd.choice(64, rnd.integers(0, 5), replace=False):
            flips[i] ^= np.uint64(1) << np.uint64(b)
    sets = [set(zip(*(x.tolist() for x in op.bucket_keys(v)))) for v in (a, a ^ flips)]
    assert {r for r, _ in sets[0] & sets[1]} == set(range(3000))


def test_golay_code():
    _, patterns = op.golay_tables()
    assert ((patterns >= 0).sum(axis=1) == 6).sum() == 1771 and ((patterns >= 0).sum(axis=1) == 1).sum() == 277


def test_awkward_rows(spark):
    got = op.groups(awkward_docs(spark)).collect()
    rows = awkward_docs(spark).collect()
    assert len(got) == len(rows)
    prints = [brute_print(r.text) for r in rows]
    comps = brute_components(prints)
    want = []
    for r, p, c in zip(rows, prints, comps):
        ids = [x.doc_id for x, d in zip(rows, comps) if d == c and x.doc_id is not None]
        want.append((r.doc_id, f"{p:016x}", min(ids, default=None)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_one_row_of_each_component_stays(spark):
    docs = awkward_docs(spark)
    kept = op.keep_rows(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    comps = {(r.component, r.component_id) for r in op.grouped(docs).collect()}
    assert len(ids) == len(comps) and sorted(map(str, ids)) == sorted(str(c) for _, c in comps)


def test_empty_table(spark):
    assert op.groups(empty_docs(spark)).count() == 0 and op.keep_rows(empty_docs(spark)).count() == 0


def test_components_of_dense_groups(spark):
    """Balls of close fingerprints, chains between them, and single ones."""
    common.prepare(spark)
    rnd = np.random.default_rng(5)
    prints = set()
    for _ in range(4):
        center = int(rnd.integers(0, 1 << 63))
        for _ in range(150):
            v = center
            for b in rnd.choice(64, rnd.integers(0, 4), replace=False):
                v ^= 1 << int(b)
            prints.add(v)
    prints |= {int(x) for x in rnd.integers(0, 1 << 63, 100)}
    prints = sorted(prints)
    comps = brute_components(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p, 1) for p in signed], "fp long, n long")
    got = {r.fp: r.comp for r in op.linked(df).collect()}
    for i, p in enumerate(signed):
        assert got[p] == min(s for s, c in zip(signed, comps) if c == comps[i])


def test_near_copies_are_linked(spark):
    df = spark.createDataFrame([(i, sentence(3, 400) + f" tail{i}") for i in range(20)] + [(99, sentence(4, 400))], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in op.groups(df).collect()}
    rows = df.collect()
    comps = brute_components([brute_print(r.text) for r in rows])
    assert [got[r.doc_id] for r in rows] == [rows[c].doc_id for c in comps]
