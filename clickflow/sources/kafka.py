"""Kafka source (S5) and sink (K4).

The Kafka connector jar is not bundled; ``kafka_stream`` / ``write_kafka`` are
the standard Structured Streaming calls and need
``org.apache.spark:spark-sql-kafka-0-10`` on the classpath.  The record
encode/decode projections are plain columns and are what the tests cover.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str = "clicks",
                 starting_offsets: str = "latest") -> DataFrame:
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load())


def decode_value(records: DataFrame, *keep: str) -> DataFrame:
    """Kafka record -> text line (``SimpleStringSchema``)."""
    return records.select(*keep, F.col("value").cast("string").alias("value"))


def encode_records(df: DataFrame, key_col: str, value_col: str, *keep: str) -> DataFrame:
    """Project rows to the Kafka record shape ``key binary, value binary``."""
    return df.select(*keep, F.col(key_col).cast("string").cast("binary").alias("key"),
                     F.col(value_col).cast("string").cast("binary").alias("value"))


def click_payload(clicks: DataFrame) -> DataFrame:
    """Click -> (key = user, value = JSON record).  The reference's serializer
    returned an empty byte array; we emit the record."""
    rec = F.struct(F.col("user_id").cast("string").alias("user"), F.col("url"),
                   F.col("ms").alias("timestamp"))
    return clicks.select("seq", F.col("user_id").cast("string").alias("key"),
                         F.to_json(rec).alias("value"))


def write_kafka(stream_df: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str):
    return (stream_df.select(F.col("key").cast("binary"), F.col("value").cast("binary"))
            .writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .start())
