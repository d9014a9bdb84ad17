import __spark_entry__ as E
from clickflow.plans import REGISTRY

RATE_ONLY: set[str] = set()  # every key has a SQL statement of its result


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(REGISTRY) <= set(q)
    assert set(REGISTRY) - set(o) == RATE_ONLY
    assert set(o) <= set(q)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "url", "cnt", "rk"]
    assert df.count() > 0


def test_keys_have_no_forbidden_names():
    # opN_ names and pipeline are the training-data queries', which the entry point adds
    for k in REGISTRY:
        assert not k.startswith("op") and "pipeline" not in k
