"""Sinks (K1-K8): console, rolling text files, keyed upsert snapshot (``sinks.upsert``),
JSON documents.  Network clients (Redis, search index, Kafka without its
jar) are out of scope; their record projections live here and in
``sources.kafka``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.functions.strings import json_object


def hour_bucket(ms_col: str = "ms"):
    """Bucket folder name by event-time hour (``yyyy-MM-dd--HH``)."""
    return F.date_format(F.timestamp_millis(F.col(ms_col)), "yyyy-MM-dd--HH")


def records_for_bytes(df: DataFrame, value: str, roll_bytes: int) -> int:
    """Records per file that approximate a byte-size roll (Spark rolls by
    record count only): ``roll_bytes`` over the average line size, measured
    with one scalar aggregate."""
    avg = df.agg(F.avg(F.octet_length(F.col(value)) + F.lit(1))).first()[0] or 1.0
    return max(1, int(roll_bytes // avg))


def write_text_files(df: DataFrame, path: str, value: str = "value", bucket: str = "bucket",
                     max_records_per_file: int = 1_000_000, order_col: str | None = None,
                     roll_bytes: int | None = None) -> None:
    """K3 (batch): row-format text files, one folder per bucket, rolled by
    record count, or by approximate size when ``roll_bytes`` is given
    (the reference rolls at 1 GiB).

    With ``order_col`` the rows are range-partitioned on (bucket, order_col)
    first: each task writes a contiguous slice, so a bucket gets a few files
    instead of one per task, and a hot bucket is still split over tasks."""
    if roll_bytes:
        max_records_per_file = records_for_bytes(df, value, roll_bytes)
    if order_col:
        df = df.repartitionByRange(bucket, order_col)
    (df.select(F.col(value).alias("value"), bucket).write.mode("overwrite")
     .partitionBy(bucket).option("maxRecordsPerFile", str(max_records_per_file)).text(path))


def stream_text_files(stream_df: DataFrame, path: str, checkpoint: str, value: str = "value",
                      bucket: str = "bucket", max_records_per_file: int = 1_000_000,
                      trigger: dict | None = None):
    """K3 (streaming): file sink with exactly-once commit log; the trigger
    interval plays the role of the time-based roll."""
    w = (stream_df.select(F.col(value).alias("value"), bucket).writeStream.format("text")
         .partitionBy(bucket).option("path", path).option("checkpointLocation", checkpoint)
         .option("maxRecordsPerFile", str(max_records_per_file)).outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def json_documents(clicks: DataFrame, key: str = "user_id", value: str = "url") -> DataFrame:
    """K6: one ``{user: url}`` document per click."""
    return clicks.select("seq", json_object(F.col(key), F.col(value)).alias("doc"))


def console(stream_df: DataFrame, label: str | None = None, mode: str = "append"):
    """K1: print a stream (label = query name)."""
    w = stream_df.writeStream.format("console").outputMode(mode).option("truncate", "false")
    if label:
        w = w.queryName(label)
    return w.start()
