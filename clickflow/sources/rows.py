"""In-memory rows (S3, S3b): small literal inputs for unit tests and examples.
``seq`` records list position, i.e. arrival order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickflow.schema import CLICK, KEYED_EVENT


def click_rows(spark: SparkSession, rows: Iterable[Sequence]) -> DataFrame:
    """rows of (user, url, timestamp_ms) -> (seq, user, url, timestamp)."""
    data = [(i, u, url, int(ts)) for i, (u, url, ts) in enumerate(rows)]
    return spark.createDataFrame(data, CLICK)


def keyed_rows(spark: SparkSession, rows: Iterable[Sequence]) -> DataFrame:
    data = [(i, k, s, int(ts)) for i, (k, s, ts) in enumerate(rows)]
    return spark.createDataFrame(data, KEYED_EVENT)


def value_rows(spark: SparkSession, values: Iterable, dtype: T.DataType) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))


def line_rows(spark: SparkSession, lines: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(x,) for x in lines], "value string")
