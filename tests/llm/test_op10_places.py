import random

from clickflow.llm import op10_winnowed_lines as op
from helpers import sentence


def all_pairs(rows, min_words=op.MIN_WORDS):
    """Text by (doc_id, text), each window held against every earlier place of it."""
    docs = [(d, t, [(n, x.split()) for n, x in enumerate(t.split("\n")) if x.split()]) for d, t in sorted(rows)]
    places = []
    for d, (_, _, lines) in enumerate(docs):
        for a in range(len(lines)):
            e, n = a, 0
            while e < len(lines) and n < min_words:
                n, e = n + len(lines[e][1]), e + 1
            if n >= min_words:
                places.append((d, a, e, [w for _, w in lines[a:e]]))
    gone = [set() for _ in docs]
    before = {}
    for d, a, e, words in places:
        equal = before.setdefault(tuple(map(tuple, words)), [])
        for f, fa, fe in equal:
            mine, other, left, right = docs[d][2], docs[f][2], 0, 0
            while left < min(a, fa) and mine[a - left - 1][1] == other[fa - left - 1][1]:
                left += 1
            while e + right < len(mine) and fe + right < len(other) and mine[e + right][1] == other[fe + right][1]:
                right += 1
            gone[d] |= {mine[i][0] for i in range(max(a - left, fe) if f == d else a - left, e + right)}
        equal.append((d, a, e))
    return {(d, t): "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, (d, t, _) in enumerate(docs)}


def results(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    op.common.prepare(spark)
    return {r.doc_id: r.text for r in op.dedup(df).collect()}


def test_repeats_inside_a_text_and_tails_of_later_places(spark):
    four = [sentence(300 + i, 15) for i in range(4)]
    window, head, tail = sentence(400, 60), sentence(401, 8), sentence(402, 10)
    docs = [(1, "\n".join([sentence(310, 60)] * 3)), (2, "\n".join([*four, *four, four[0]])),
            (3, f"a\n{window}\nb"), (4, f"{head}\n{window}\n{tail}\nc"), (5, f"d\n{window}\n{tail}\ne"), (6, f"{head}\n{window}\nf")]
    got = results(spark, docs)
    assert got[1] == sentence(310, 60) and got[2] == "\n".join(four)
    assert got[3] == docs[2][1] and got[4] == f"{head}\n{tail}\nc"
    assert got[5] == "d\ne" and got[6] == "f"
    assert got == {d: all_pairs(docs)[d, t] for d, t in docs}


def test_random_texts_against_all_pairs(spark):
    rnd = random.Random(5)
    pool = [sentence(500 + i, rnd.choice((3, 12, 20, 30))) for i in range(5)]
    docs = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 14)))) for i in range(60)]
    want = all_pairs(docs)
    assert results(spark, docs) == {d: want[d, t] for d, t in docs}


def test_every_text_selects_what_equal_windows_need():
    """Equal windows select the same line, and a text stores a selected line once."""
    rnd = random.Random(6)
    pool = [sentence(700 + i, rnd.choice((3, 12, 20, 30))) for i in range(8)]
    by_window = {}
    for _ in range(80):
        text = "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 20)))
        _, digests, sizes = op.hashed_lines(text)
        rows = list(op.selected(text))
        held = [(a, e) for _, found in rows for a, e, _ in found]
        assert sorted(held) == op.windows(sizes) and len(rows) <= len(digests)
        for key, found in rows:
            for a, e, h in found:
                assert by_window.setdefault(tuple(digests[a:e]), (key, h)) == (key, h)
                assert sizes[a:e].sum() >= op.MIN_WORDS
                assert sizes[a:e - 1].sum() < op.MIN_WORDS or sizes[a + 1:e].sum() < op.MIN_WORDS


def test_repeated_rows_and_a_hot_window(spark):
    hot = sentence(900, 55)
    docs = [(i, f"{sentence(1000 + i, 5)}\n{hot}\n{sentence(2000 + i, 5)}") for i in range(300)]
    got = results(spark, docs + docs[:5])
    assert got[0] == docs[0][1]
    assert all(got[i] == f"{sentence(1000 + i, 5)}\n{sentence(2000 + i, 5)}" for i in range(1, 300))
