"""The grammar goes to its end, its incremental counts are right, and files of any width read back."""

import random
from collections import Counter

import numpy as np
import pytest

from clickflow.llm import op6_repair_ids as rp


def block(seed, n, ids, run=0.2):
    rnd, out = random.Random(seed), []
    phrases = [[rnd.randrange(ids) for _ in range(rnd.randint(2, 9))] for _ in range(40)]
    while len(out) < n:
        out += [out[-1]] * rnd.randint(1, 9) if out and rnd.random() < run else rnd.choice(phrases)
    ends = np.zeros(len(out), dtype=bool)
    ends[[i for i in range(len(out)) if rnd.random() < 0.02]] = True
    ends[-1] = True
    return np.array(out, dtype="<u4"), ends


@pytest.mark.parametrize("seed,n,ids", [(1, 20_000, 30), (2, 5_000, 3), (3, 20_000, 500), (4, 30, 5), (5, 1, 5)])
def test_no_frequent_pair_is_left(seed, n, ids):
    seq, ends = block(seed, n, ids)
    rules, symbols, after = rp.grammar(seq, ends, ids)
    assert (rp.expand(symbols, rules, ids) == seq).all()
    inside = ~after[:-1]
    pairs, count = np.unique((symbols[:-1] << 32 | symbols[1:])[inside], return_counts=True)
    assert (count < rp.MIN_COUNT).all()
    # documents keep their ids
    sizes = np.r_[np.ones(ids, dtype=np.int64), rp.expansion_lengths(rules, ids)][symbols]
    assert (np.flatnonzero(ends) == np.cumsum(sizes)[after] - 1).all()
    if n >= 5000:
        assert len(symbols) < len(seq) / 2


def recounted(seq, ends, vocabulary):
    """The same grammar with all pairs counted anew in each round."""
    seq, ends, rules = seq.astype(np.int64).tolist(), ends.tolist(), []
    while True:
        count = Counter(p for p, e in zip(zip(seq, seq[1:]), ends) if not e)
        often = sorted((-n, p) for p, n in count.items() if n >= rp.MIN_COUNT and n >= max(count.values()) // rp.BAND)
        if not often:
            return rules, seq, ends
        taken, lefts, rights = [], set(), set()
        for _, (a, b) in often:
            if a in rights or b in lefts or (a == b and (a in lefts or a in rights)):
                continue
            lefts.add(a)
            rights.add(b)
            taken.append((a, b))
        number = {p: vocabulary + len(rules) + k for k, p in enumerate(sorted(taken))}
        rules += [list(p) for p in sorted(taken)]
        out, marks, i = [], [], 0
        while i < len(seq):
            new = number.get((seq[i], seq[i + 1])) if i + 1 < len(seq) and not ends[i] else None
            i += new is not None
            out.append(seq[i] if new is None else new)
            marks.append(ends[i])
            i += 1
        seq, ends = out, marks


@pytest.mark.parametrize("seed,n,ids,run", [(11, 3000, 2, 0.8), (12, 4000, 30, 0.2), (13, 4000, 500, 0.0), (14, 400, 1, 0.5), (15, 1, 3, 0.0)])
def test_rules_are_those_of_a_full_recount(seed, n, ids, run):
    seq, ends = block(seed, n, ids, run)
    want = recounted(seq, ends, ids)
    assert [x.tolist() for x in rp.grammar(seq, ends, ids)] == list(want)
    # ids too wide for a pair and its place in one number
    got = rp.grammar(seq + np.uint32(1 << 29), ends, ids + (1 << 29))
    assert [(got[0] - (1 << 29)).tolist(), (got[1] - (1 << 29)).tolist(), got[2].tolist()] == list(want)


def test_pair_index_finds_all_and_nothing_else():
    rng = np.random.default_rng(7)
    codes = np.unique(rng.integers(0, 1 << 40, 5000))
    index = rp.PairIndex(codes)
    asked = np.concatenate([codes[::3], rng.integers(0, 1 << 40, 5000), codes[:10]])
    at, place = index.find(asked)
    assert set(at.tolist()) == {i for i, c in enumerate(asked.tolist()) if c in set(codes.tolist())}
    assert (codes[place] == asked[at]).all()


@pytest.mark.parametrize("width,top", [(2, 60_000), (3, 1 << 20), (4, 1 << 25)])
def test_symbols_of_any_width(width, top):
    rng = np.random.default_rng(width)
    ids = [rng.integers(0, top, n).astype("<u4").tobytes() for n in (5, 1, 300)]
    row = rp.encode_block(ids, [1, 2, 3], top)
    assert row["width"] == width and len(row["symbols"]) % width == 0
    assert [x.tobytes() for _, _, x in rp.decode_block(row)] == ids
    assert rp.decode_document(row, 2, 7, 20).tobytes() == ids[2][28:108]
