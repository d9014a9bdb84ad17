"""Registry of named queries: a Spark builder plus, where SQL can state the
same result, an independent oracle query (DuckDB dialect) over the same
parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    streaming: bool = False
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, streaming: bool = False):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, streaming, (fn.__doc__ or "").strip())
        return fn
    return deco


# Oracle building blocks (DuckDB).  ``ck`` is the click view of ``events``;
# milliseconds are floored from microseconds to match Spark's unix_millis.
CK = ("ck AS (SELECT event_id AS seq, user_id, event_type AS url, "
      "epoch_us(ts)//1000 AS ms, ts, value FROM events)")


def sql_ts_text(ms: str) -> str:
    """DuckDB twin of functions.timefmt.sql_timestamp_text."""
    return (f"(strftime(make_timestamp(({ms})*1000), '%Y-%m-%d %H:%M:%S') || '.' || "
            f"CASE WHEN ({ms})%1000 = 0 THEN '0' ELSE "
            f"rtrim(lpad(CAST(({ms})%1000 AS VARCHAR), 3, '0'), '0') END)")


def sql_event_text(user: str = "user_id", url: str = "url", ts: str = "ms") -> str:
    return (f"('Event{{user=''' || CAST({user} AS VARCHAR) || ''', url=''' || {url} || "
            f"''', timestamp=' || CAST({ts} AS VARCHAR) || '}}')")


def sql_java_words(line: str) -> str:
    """DuckDB twin of functions.strings.java_split(line, ' ')."""
    return (f"CASE WHEN length({line}) > 0 AND length(rtrim({line}, ' ')) = 0 "
            f"THEN []::VARCHAR[] ELSE string_split(rtrim({line}, ' '), ' ') END")
