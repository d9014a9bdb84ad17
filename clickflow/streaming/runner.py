"""Run a streaming query to completion over the data available now and hand
back its output as a batch DataFrame.

The sink is ``foreachBatch`` writing each micro-batch to its own folder
``batch_id=<n>`` with overwrite, so a batch replayed after a failure replaces
its earlier attempt (idempotent, exactly-once output).  Checkpoint and output
live under ``spark.checkpoint.dir``.  A run given the ``paths`` of an earlier one
resumes from its checkpoint; without them each run starts in fresh folders.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.session import hadoop_path, path_exists, scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str] | None):
    """Temporarily set SQL confs for one query, restoring them afterwards."""
    old = {}
    for k, v in (conf or {}).items():
        old[k] = spark.conf.get(k, None)
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _as_dict(p) -> dict:
    if isinstance(p, dict):
        return p
    return json.loads(p.json)


def batch_clock(spark: SparkSession, checkpoint: str, batch_id: int) -> tuple[int, int]:
    """(event-time watermark, wall-clock start) in epoch milliseconds under which a
    micro-batch runs.  Spark writes both to the checkpoint's offset log before it starts the
    batch, so a batch that runs again after a failure gets the same ones."""
    fs, p = hadoop_path(spark, f"{checkpoint}/offsets/{batch_id}")
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    meta = json.loads(text.split("\n")[1])   # a version line, the batch's metadata, its offsets
    return int(meta["batchWatermarkMs"]), int(meta["batchTimestampMs"])


class StreamResult:
    def __init__(self, spark: SparkSession, path: str, schema, progress: list[dict], written: int = 0):
        self.spark, self.path, self.schema, self.progress, self.written = spark, path, schema, progress, written

    def batches(self) -> DataFrame:
        """All emitted rows with their ``batch_id``."""
        if not path_exists(self.spark, self.path):
            if self.written:
                raise RuntimeError(f"{self.written} micro-batches were written to {self.path}, which is gone")
            return self.spark.createDataFrame([], self.schema).withColumn("batch_id", F.lit(0).cast("int"))
        return self.spark.read.parquet(self.path)

    def rows(self) -> DataFrame:
        return self.batches().drop("batch_id")

    def last_per_key(self, keys: list[str]) -> DataFrame:
        """Update-mode output reduced to each key's last emitted row."""
        b = self.batches()
        cols = [c for c in b.columns if c not in keys and c != "batch_id"]
        last = b.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("_r"))
        return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def state_partitions(spark: SparkSession) -> int:
    """Partitions for a new stateful query (fixed for the life of its
    checkpoint): the session's shuffle partitions.  In local mode they are
    capped at the core count, since each state partition costs a fixed amount
    per micro-batch; on a cluster the setting is used as is (executor counts
    seen at start-up say little under dynamic allocation)."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if spark.sparkContext.master.startswith("local"):
        return max(1, min(shuffle, spark.sparkContext.defaultParallelism))
    return shuffle


def run_available_now(stream_df: DataFrame, name: str, mode: str = "append",
                      batch_fn: Callable[[DataFrame], DataFrame] | None = None,
                      conf: dict[str, str] | None = None, timeout_s: int | None = None,
                      batch_fn_id: Callable[[DataFrame, int], DataFrame] | None = None,
                      paths: tuple[str, str] | None = None,
                      batch_fn_clock: Callable[[DataFrame, int, int], DataFrame] | None = None) -> StreamResult:
    """``batch_fn`` / ``batch_fn_id`` / ``batch_fn_clock`` turn each micro-batch
    into the rows to write (the second also gets the batch id, the third that and
    the watermark in ms under which the batch runs); the micro-batch is persisted
    while they run, since such functions read it more than once.  ``paths``
    = (output, checkpoint) resumes an earlier run of the same query.
    ``timeout_s`` None waits until everything available is processed (an
    availableNow run always ends)."""
    spark = stream_df.sparkSession
    conf = {"spark.sql.shuffle.partitions": str(state_partitions(spark)),
            # progress of every micro-batch, a few KB each (the default keeps the last 100)
            "spark.sql.streaming.numRecentProgressUpdates": "100000", **(conf or {})}
    out, ckpt = paths or (scratch_path(spark, "out", name), scratch_path(spark, "ckpt", name))
    holder: dict = {}

    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch_fn is None and batch_fn_id is None and batch_fn_clock is None:
            b, cached = batch, None
        else:
            cached = batch.persist()
            if batch_fn_clock:
                b = batch_fn_clock(cached, batch_id, batch_clock(spark, ckpt, batch_id)[0])
            else:
                b = batch_fn_id(cached, batch_id) if batch_fn_id else batch_fn(cached)
        try:
            holder.setdefault("schema", b.schema)
            b.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            holder["written"] = holder.get("written", 0) + 1
        finally:
            if cached is not None:
                cached.unpersist()

    with session_conf(spark, conf):
        q = (stream_df.writeStream.queryName(f"{name}_{ckpt[-12:]}").outputMode(mode)
             .foreachBatch(sink).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        try:
            finished = q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
            if finished is False:
                raise TimeoutError(f"streaming query {name} did not finish in {timeout_s}s")
            if q.exception() is not None:
                raise RuntimeError(f"streaming query {name} failed: {q.exception()}")
        finally:
            if q.isActive:
                q.stop()
    schema = holder.get("schema")
    if schema is None:
        empty = spark.createDataFrame([], stream_df.schema)
        schema = (batch_fn(empty) if batch_fn else empty).schema if batch_fn_id is None and batch_fn_clock is None else None
        if schema is None:
            raise RuntimeError(f"streaming query {name} produced no micro-batch")
    progress = [_as_dict(p) for p in q.recentProgress]
    return StreamResult(spark, out, schema, progress, holder.get("written", 0))
