"""Readers for the driver's parquet tables and the click view over ``events``.

Readers return lazy DataFrames with no column list of their own: downstream
``select``/``filter`` reach the parquet scan through Catalyst (ReadSchema and
PushedFilters show it in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F, types as T

from clickflow.session import hadoop_path, use_utc


_SCHEMAS: dict[tuple, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's files as they are now.  Inferring a schema is a Spark job of
    its own; it is done once for each state (time and length) of the path."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = table_state(spark, sf_dir, name)
    if not key[1]:
        return spark.read.parquet(path)   # no such path (Spark's own error), or a store without times
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def table_state(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, int, int]:
    """(path, time, length) of a table; another one after it was rewritten."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return path, 0, 0
    st = fs.getFileStatus(p)
    return path, st.getModificationTime(), st.getLen()


def click_view(events: DataFrame) -> DataFrame:
    """events -> clicks: ``seq`` = event_id (its order is the ts order),
    ``user_id``, ``url`` = event_type, ``ts`` TIMESTAMP, ``ms`` epoch millis
    (floored), ``value``.

    ``events.ts`` is TIMESTAMP_NTZ, which watermarks reject; it is read as UTC
    wall-clock and cast to TIMESTAMP.
    """
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id"),
        F.col("event_type").alias("url"),
        ts.alias("ts"),
        F.unix_millis(ts).alias("ms"),
        F.col("value"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return click_view(table(spark, sf_dir, "events"))


def from_click_records(df: DataFrame) -> DataFrame:
    """Reference-shaped rows ``(seq, user, url, timestamp)`` -> click view."""
    use_utc(df.sparkSession)
    return df.select(
        F.col("seq"), F.col("user").alias("user_id"), F.col("url"),
        F.timestamp_millis(F.col("timestamp")).alias("ts"),
        F.col("timestamp").alias("ms"),
    )
