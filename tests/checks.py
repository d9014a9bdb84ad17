"""What several test modules share; not in conftest.py, whose name tests/llm/ has too."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
