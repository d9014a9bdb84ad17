"""Every streaming key, run with a different micro-batch split (3 slices of 1
file instead of 4 slices of 2), still equals its SQL oracle: results do not
depend on how the input is cut into micro-batches."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from clickflow.plans import streams as S
from checks import SF_SMALL

# these keys state the batching itself (slice order, per-batch watermark)
BATCH_DEPENDENT = {"stream_late_data", "stream_element_watermark", "stream_late_rows", "stream_progress"}
KEYS = sorted(k for k in E.queries() if k.startswith("stream_") and k not in BATCH_DEPENDENT)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in ("events", "documents", "nation", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("key", KEYS)
def test_stream_key_independent_of_batching(spark, oracle, monkeypatch, key):
    monkeypatch.setattr(S, "CHUNKS", 3)
    monkeypatch.setattr(S, "FILES_PER_CHUNK", 1)
    df = E.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = oracle.sql(E.oracle_sql()[key])
    idx = [rel.columns.index(c) for c in cols]
    exp = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == exp
