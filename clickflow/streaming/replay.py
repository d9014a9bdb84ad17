"""Click replay (S4 re-aimed): a bounded table written as a sequence of
time-ordered file groups, so a file-source stream sees it arrive in event-time
order, one group per micro-batch.

* The replay folder lives below ``spark.checkpoint.dir`` (shared storage).
* Slices are equal-width ranges of the order column, selected with range
  predicates on the raw column (pushed into the parquet scan).  Their number is
  fixed by the caller, whatever the table's size.
* Each slice is one distributed write, range-partitioned into the same number of
  files, sized by the largest slice (``rows_per_file``), so no task writes more
  than about that many rows.  A short or empty slice is padded with empty files.
* Slices are written oldest first: the file source orders files by
  modification time, and ``maxFilesPerTrigger = files_per_chunk`` makes every
  micro-batch exactly one slice (checked after each write).
"""

from __future__ import annotations

import math
import time
import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.session import hadoop_path, scratch_path

_CACHE: dict[tuple, "Replay"] = {}
_EPOCH = datetime(1970, 1, 1)
ROWS_PER_FILE = 4_000_000


class Replay:
    def __init__(self, path: str, schema, files_per_chunk: int, fmt: str):
        self.path, self.schema, self.files_per_chunk, self.fmt = path, schema, files_per_chunk, fmt

    def stream(self, spark: SparkSession) -> DataFrame:
        r = (spark.readStream.format(self.fmt).option("maxFilesPerTrigger", str(self.files_per_chunk)))
        if self.fmt == "text":
            r = r.option("lineSep", "\n")   # lines as in the batch form: split on \n only
        else:
            r = r.schema(self.schema)
        return r.load(self.path)


def _as_int(v) -> tuple[int, bool]:
    if isinstance(v, datetime):
        return (v - _EPOCH) // timedelta(microseconds=1), True
    return math.floor(v), False   # floor: every value lies in [min, max + 1)


def _literal(v: int, is_ts: bool) -> Column:
    if is_ts:
        return F.expr(f"TIMESTAMP_NTZ '{(_EPOCH + timedelta(microseconds=v)).isoformat(sep=' ')}'")
    return F.lit(v)


def slice_predicates(df: DataFrame, order_col: str, chunks: int) -> list[Column]:
    """``chunks`` equal-width ranges over [min, max] of ``order_col`` (a number
    or a TIMESTAMP_NTZ); row r is in slice floor((x - min) * chunks / (max - min + 1))."""
    b = df.agg(F.min(order_col).alias("lo"), F.max(order_col).alias("hi")).first()
    if b["lo"] is None:
        return [F.lit(False)] * chunks
    (lo, is_ts), (hi, _) = _as_int(b["lo"]), _as_int(b["hi"])
    span = hi - lo + 1
    edges = [lo + -(-c * span // chunks) for c in range(chunks + 1)]  # ceil division
    col = F.col(order_col)
    return [(col >= _literal(edges[c], is_ts)) & (col < _literal(edges[c + 1], is_ts)) for c in range(chunks)]


def _count_files(spark: SparkSession, path: str) -> int:
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return 0
    return sum(1 for st in fs.listStatus(p) if st.getPath().getName().startswith("part-"))


def _pad(spark: SparkSession, path: str, fmt: str, schema, missing: int) -> None:
    """Add ``missing`` empty files of the replay's format: one is written, the
    others are copies of it."""
    blank = scratch_path(spark, "replay-blank")
    spark.createDataFrame([], schema).coalesce(1).write.format(fmt).save(blank)
    fs, p = hadoop_path(spark, blank)
    jvm = spark.sparkContext._jvm
    one = next((st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-")), None)
    for _ in range(missing):
        to = jvm.org.apache.hadoop.fs.Path(f"{path}/part-pad-{uuid.uuid4().hex}.{fmt}")
        if one is None:
            fs.create(to).close()
        else:
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, one, fs, to, False, spark.sparkContext._jsc.hadoopConfiguration())


def write_replay(spark: SparkSession, df: DataFrame, order_col: str, name: str, chunks: int = 4,
                 min_files_per_chunk: int = 2, chunk_order: list[int] | None = None,
                 fmt: str = "parquet", value_col: str | None = None, cache_key: tuple | None = None,
                 rows_per_file: int = ROWS_PER_FILE) -> Replay:
    """Write ``df`` as ``chunks`` slices of ``order_col``, one slice after the
    other in ``chunk_order`` (default: oldest first).  Rows with a null order
    value have no place in time and are left out."""
    if cache_key is not None and cache_key in _CACHE:
        return _CACHE[cache_key]
    path = scratch_path(spark, "replay", name)
    preds = slice_predicates(df, order_col, chunks)
    largest = max(df.agg(*(F.count(F.when(p, 1)).alias(f"n{i}") for i, p in enumerate(preds))).first())
    files = max(min_files_per_chunk, math.ceil(largest / rows_per_file))
    fs, _ = hadoop_path(spark, path)
    coarse_times = fs.getUri().getScheme() != "file"
    written = 0
    for i, c in enumerate(chunk_order or list(range(chunks))):
        part = df.filter(preds[c]).repartitionByRange(files, order_col).sortWithinPartitions(order_col)
        if fmt == "text":
            part = part.select(value_col)
        part.write.mode("append").format(fmt).save(path)
        now = _count_files(spark, path)
        if now - written < files:
            _pad(spark, path, fmt, part.schema, files - (now - written))
            now = _count_files(spark, path)
        if now - written != files:
            raise RuntimeError(f"replay slice {c} of {name} wrote {now - written} files, expected {files}; "
                               "micro-batches would not align with slices")
        written = now
        if i + 1 < chunks and coarse_times:
            time.sleep(1.0)  # object stores keep second-resolution mtimes
    r = Replay(path, df.schema if fmt != "text" else None, files, fmt)
    if cache_key is not None:
        _CACHE[cache_key] = r
    return r


def events_replay(spark: SparkSession, sf_dir: str, chunks: int = 4, files_per_chunk: int = 2,
                  chunk_order: list[int] | None = None) -> Replay:
    """``events`` replayed in event-time order (or a given slice order)."""
    from clickflow.sources.tables import table, table_state
    ev = table(spark, sf_dir, "events")
    key = (*table_state(spark, sf_dir, "events"), chunks, files_per_chunk, tuple(chunk_order or ()))
    return write_replay(spark, ev, "ts", "events", chunks, files_per_chunk, chunk_order, cache_key=key)
