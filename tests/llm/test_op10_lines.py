from clickflow.llm import common, op10_winnowed_lines as op
from helpers import awkward_docs, empty_docs, sentence
from test_op10_places import all_pairs

SF = "/root/testdata/sf0.01"


def brute(rows):
    """Text by (doc_id, text) after cutting, each window held against every earlier place."""
    docs = sorted({(r[0] if r[0] is not None else op.LONGEST, r[1]) for r in rows if r[1] is not None})
    return all_pairs(docs)


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = brute(rows)
    expect = [(i, None if t is None else want[i if i is not None else op.LONGEST, t]) for i, t in rows]
    got = [(r.doc_id, r.text) for r in op.dedup(df).collect()]
    assert sorted(got, key=str) == sorted(expect, key=str)
    return sum(a != b for (_, a), (_, b) in zip(rows, expect))


def test_awkward_rows(spark):
    common.prepare(spark)
    assert check(awkward_docs(spark)) >= 2
    kept = op.keep_rows(awkward_docs(spark))
    assert kept.columns == awkward_docs(spark).columns and kept.count() == awkward_docs(spark).count()


def test_empty_table(spark):
    common.prepare(spark)
    assert op.dedup(empty_docs(spark)).count() == 0


def test_whole_table_against_brute_force(spark):
    assert check(common.table(spark, SF, "documents")) > 10


def test_runs_of_short_lines_and_extensions(spark):
    common.prepare(spark)
    run = [sentence(20 + i, 9) for i in range(12)]
    docs = [(1, "\n".join(["x y", *run, "z"])), (2, "\n".join(["other", *run[2:9], "tail"])), (3, "\n".join([*run[:5], "gap", *run[5:]])),
            (4, "\n".join(run[:4])), (5, "\n".join([*run, *run]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert check(df) >= 3
    got = {r.doc_id: r for r in op.dedup(df).collect()}
    assert got[2].text == "other\ntail" and got[2].n_removed_lines == 7
    assert got[4].text == docs[3][1]  # 36 words
    assert got[5].text == "" and got[5].n_removed_lines == 24
