"""Fill-in-middle by the skip list: ranks, exact round trips, and the SQL statement."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from clickflow.llm import common, op11_fim_skiplist as op
from helpers import awkward_docs, empty_docs

SF = "/root/testdata/sf0.01"


@given(st.lists(st.integers(0, 9), max_size=300))
@settings(max_examples=60, deadline=None)
def test_places_are_prefix_sums(widths):
    units = op.SkipList(np.array(widths, dtype=np.int64))
    assert [units.place(r) for r in range(len(widths) + 1)] == [sum(widths[:r]) for r in range(len(widths) + 1)]


def test_a_long_list_has_lanes_and_few_steps():
    n = 200_000
    units = op.SkipList(np.arange(n) % 7)
    sizes = [len(x.units) for x in units.lanes]
    assert len(sizes) >= 4 and all(a > 4 * b for a, b in zip(sizes, sizes[1:]))
    assert all(x.units.sum() == n and x.chars.sum() == (np.arange(n) % 7).sum() for x in units.lanes)
    total = np.r_[0, np.cumsum(np.arange(n) % 7)]
    assert all(units.place(r) == total[r] for r in (0, 1, 2, 65_535, 65_536, 99_999, n - 1, n))
    with pytest.raises(IndexError):
        units.place(n + 1)


def brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        out, form, a, b = text, "plain", None, None
    else:
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = text[:a], text[a:b], text[b:]
        form = "spm" if h4 % 100 < 20 else "psm"
        out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return doc_id, n, form, a, None if a is None else b - a, sha(out), sha(text)


def got(df):
    cols = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in op.digests(df).collect()), key=str)


def test_awkward_rows_against_brute_force(spark):
    common.prepare(spark)
    df = awkward_docs(spark)
    assert got(df) == sorted((brute(r.doc_id, r.text) for r in df.collect()), key=str)
    assert got(empty_docs(spark)) == []


def test_sentinels_and_their_parts(spark):
    common.prepare(spark)
    odd = ["<P>", "a<S>b", "x<M", "<<P", "<P", "S>", "><S", "M><", "<", ">", "\U0001f600" * 5, "a\nb\r\n\x00c", "é" * 3 + "́" * 4, "x" * 3_000_000]
    rows = [(i * len(odd) + k, t) for i in range(12) for k, t in enumerate(odd) if len(t) < 100 or i < 2]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == sorted((brute(*r) for r in rows), key=str)
    forms = {r.form for r in op.transform(df).collect()}
    assert forms == {"plain", "psm", "spm"}


def test_other_units(spark):
    common.prepare(spark)
    words = r"[^ ]+"
    assert op.unit_widths("  two words ", re.compile(words)).tolist() == [6, 6]
    rows = [(i, t) for i in range(40) for t in (f"some words {i} in  a row ", "   ", "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = op.transform(df, unit=words).withColumn("back", op.restored()).collect()
    assert sorted((r.doc_id, r.back) for r in out) == sorted(rows)
    for r in out:
        if r.form != "plain":
            text = r.back
            cuts = [0, *np.cumsum(op.unit_widths(text, re.compile(words))).tolist()]
            assert (cuts[r.prefix_units], cuts[r.prefix_units + r.middle_units]) == (r.prefix_chars, r.prefix_chars + r.middle_chars)


def test_query_against_sql(spark):
    docs = common.table(spark, SF, "documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(map(tuple, con.execute(op.SQL).fetchall()), key=str)
    assert got(docs) == want and len(want) == docs.count()
