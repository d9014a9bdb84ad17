"""K5: keyed upsert into a hash-bucketed snapshot table.

The snapshot is dealt to a fixed number of buckets by a hash of the keys.  A micro-batch
merges only the buckets it touches and writes them as ``data/batch=<id>/bucket=<b>``; its
manifest, ``manifest/<id>.json``, names for every bucket the batch that wrote it last, and
writing it is the commit.  A batch that runs again reads the manifest of the batch before
and overwrites its own folders (idempotent); a batch after the first without that manifest is
an error, not an empty start.  Buckets that neither of the last two manifests names are removed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.session import hadoop_path, path_exists

BUCKETS = 64


def bucket_path(root: str, batch_id: int, bucket: int) -> str:
    return f"{root}/data/batch={batch_id}/bucket={bucket}"


def manifest_path(root: str, batch_id: int) -> str:
    return f"{root}/manifest/{batch_id}.json"


def read_manifest(spark: SparkSession, root: str, batch_id: int) -> dict[int, int]:
    """Bucket -> batch that wrote it, after ``batch_id``."""
    path = manifest_path(root, batch_id)
    if not path_exists(spark, path):
        raise RuntimeError(f"no manifest {path}: the snapshot of batch {batch_id} is gone")
    fs, p = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {int(b): v for b, v in json.loads(text)["buckets"].items()}


def write_manifest(spark: SparkSession, root: str, batch_id: int, buckets: dict[int, int]) -> None:
    fs, p = hadoop_path(spark, manifest_path(root, batch_id))
    tmp = p.suffix(".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps({"buckets": buckets}).encode()))
    out.close()
    fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise RuntimeError(f"the manifest {p} could not be written")


def merge_latest(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Per key the row with the largest ``order`` value (newer wins)."""
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return last.select(*[c if c in keys else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def upsert_batch(batch: DataFrame, batch_id: int, root: str, keys: Sequence[str], order: str, buckets: int = BUCKETS) -> None:
    spark = batch.sparkSession
    before = read_manifest(spark, root, batch_id - 1) if batch_id > 0 else {}
    of = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    newest = merge_latest(batch, keys, order)
    touched = [r["b"] for r in batch.select(of.alias("b")).distinct().collect()]   # at most `buckets` numbers
    old = [bucket_path(root, before[b], b) for b in touched if b in before]
    if old:
        newest = merge_latest(spark.read.schema(batch.schema).parquet(*old).unionByName(newest), keys, order)
    if touched:
        (newest.withColumn("bucket", of).repartition("bucket").write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{root}/data/batch={batch_id}"))
    write_manifest(spark, root, batch_id, before | {b: batch_id for b in touched})
    if batch_id < 2 or not path_exists(spark, manifest_path(root, batch_id - 2)):
        return
    for b, v in read_manifest(spark, root, batch_id - 2).items():
        if before[b] != v:
            fs, gone = hadoop_path(spark, bucket_path(root, v, b))
            fs.delete(gone, True)
    fs, gone = hadoop_path(spark, manifest_path(root, batch_id - 2))
    fs.delete(gone, False)


def upsert_stream(stream_df: DataFrame, root: str, checkpoint: str, keys: Sequence[str], order: str,
                  trigger: dict | None = None, buckets: int = BUCKETS):
    """Start the sink; a run with the same folders resumes where the last one ended."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            upsert_batch(held, batch_id, root, keys, order, buckets)
        finally:
            held.unpersist()

    return (stream_df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The rows that the newest manifest names (at most two manifests are there)."""
    fs, p = hadoop_path(spark, f"{root}/manifest")
    newest = max(int(st.getPath().getName().partition(".")[0]) for st in fs.listStatus(p) if st.getPath().getName().endswith(".json"))
    paths = [bucket_path(root, v, b) for b, v in sorted(read_manifest(spark, root, newest).items())]
    return spark.read.parquet(*paths)
