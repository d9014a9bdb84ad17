"""K3: text files that roll by exact size, and when their bucket was idle.

The bytes written before a line in its bucket come from the blocked prefix scan, and
``part = floor(bytes before / roll_bytes)``: every part but a bucket's last holds
``roll_bytes`` within one line, and no part is ever measured again.  Each (bucket, part)
is one file of one task, ``bucket=<b>/part=<p>``, lines in order.

On a stream the bytes of each bucket so far, and the time it was last written at, are kept
as a log (``streaming.keyed_log``), so a part goes on in the next micro-batch until it is
full.  A bucket that got nothing for ``idle_ms`` by the clock of the micro-batches starts
a new part.  Files of a micro-batch lie in ``batch_id=<n>``, overwritten when it runs again;
``read_rolled`` reads them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators.scan import adaptive_block, prefix_scan
from clickflow.session import scratch_path
from clickflow.streaming.keyed_log import KeyedLog
from clickflow.streaming.runner import batch_clock



def with_parts(df: DataFrame, order: str, roll_bytes: int, before: DataFrame | None = None) -> DataFrame:
    """(value, bucket, order, bytes, part); ``before``: (bucket, bytes) written earlier."""
    rows = df.select(order, "bucket", F.coalesce("value", F.lit("")).alias("value"))
    size = F.octet_length("value") + 1
    rows = prefix_scan(rows, ["bucket"], [order], adaptive_block(df, order), {"bytes": ("sum", size)})
    start = F.col("bytes") - size
    if before is not None:
        known = before.select(F.col("bucket").alias("_b"), F.col("bytes").alias("_before"))
        rows = rows.join(known, F.col("bucket").eqNullSafe(F.col("_b")), "left").drop("_b")
        start = start + F.coalesce("_before", F.lit(0))
    return rows.withColumn("part", F.floor(start / roll_bytes).cast("long")).withColumn("bytes", size)


def _write(rows: DataFrame, order: str, path: str) -> None:
    (rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part", order).select("value", "bucket", "part")
     .write.mode("overwrite").partitionBy("bucket", "part").text(path))


def write_rolled(df: DataFrame, path: str, order: str, roll_bytes: int) -> None:
    """Write ``value`` lines of ``df`` by ``bucket``, in ``order``; the input is read once."""
    _write(with_parts(df, order, roll_bytes), order, f"{path}/batch_id=0")


def read_rolled(spark: SparkSession, path: str) -> DataFrame:
    """(value, bucket, part) of all files; no files, no rows."""
    schema = "value string, batch_id int, bucket string, part long"
    return spark.read.schema(schema).text(path).select("value", "bucket", "part")


def rolled_batch(batch: DataFrame, batch_id: int, clock_ms: int, log: KeyedLog, path: str, order: str,
                 roll_bytes: int, idle_ms: int | None) -> None:
    """Write one micro-batch; ``log`` has (bucket, bytes, last_ms)."""
    before = log.before(batch_id)
    pad = F.lit(0).cast("long")
    if idle_ms is not None:  # the open part of an idle bucket counts as full
        pad = F.when(F.col("last_ms") + idle_ms < clock_ms, F.pmod(-F.col("bytes"), F.lit(roll_bytes))).otherwise(pad)
    before = before.withColumn("pad", pad)
    rows = with_parts(batch, order, roll_bytes, before.withColumn("bytes", F.col("bytes") + F.col("pad")))
    _write(rows, order, f"{path}/batch_id={batch_id}")
    added = batch.groupBy("bucket").agg(F.sum(F.octet_length(F.coalesce("value", F.lit(""))) + 1).alias("own"))
    known = before.select(F.col("bucket").alias("_b"), "pad")
    added = added.join(known, F.col("bucket").eqNullSafe(F.col("_b")), "left")
    log.write(batch_id, added.select("bucket", (F.col("own") + F.coalesce("pad", F.lit(0))).alias("bytes"),
                                     F.lit(clock_ms).cast("long").alias("last_ms")))


def rolled_files_stream(stream_df: DataFrame, path: str, checkpoint: str, order: str, roll_bytes: int,
                        idle_ms: int | None = None, log_path: str | None = None, trigger: dict | None = None):
    """Start the sink (``value``, ``bucket`` and the order column)."""
    spark = stream_df.sparkSession
    log = KeyedLog(spark, "rolled", "bucket string, bytes long, last_ms long", ["bucket"], {"bytes": "sum", "last_ms": "max"},
                   log_path or f"{checkpoint}-bytes")

    def sink(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            rolled_batch(held, batch_id, batch_clock(spark, checkpoint, batch_id)[1], log, path, order, roll_bytes, idle_ms)
        finally:
            held.unpersist()

    return (stream_df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
            .trigger(**(trigger or {"availableNow": True})).start())
