"""The reference's jobs with their default parameters, over any click input.

Registered queries (``plans``) run on the driver's tables; these functions take
a user's own clicks, either text lines ``user,url, timestamp`` (the wire
format of the reference's Kafka job) or parquet with ``user, url, timestamp``
(epoch ms).  Arrival order is the order of the input (``seq``): file name, then position.
``STREAM_JOBS`` are the same jobs as streams over a folder of such files, or a topic.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickflow.operators import aggregates as A
from clickflow.operators import transforms as P
from clickflow.operators import windows as W
from clickflow.operators.changelog import changelog_count
from clickflow.operators.combine import co_map_union, join_text, keyed_join
from clickflow.operators.ranking import report, top_n
from clickflow.operators.timers import periodic_counts, pv_report_text, timer_per_event, timer_per_event_stream
from clickflow.session import scratch_path, use_utc
from clickflow.sinks import hour_bucket
from clickflow.sinks.rolling import rolled_files_stream
from clickflow.sinks.upsert import read_snapshot, upsert_stream
from clickflow.sources.kafka import click_payload, decode_value, kafka_stream, write_kafka
from clickflow.sources.tables import from_click_records
from clickflow.sources.text import read_lines, stream_lines
from clickflow.streaming.due_ticks import DueTicks
from clickflow.streaming.keyed_totals import KeyedTotals
from clickflow.streaming.runner import run_available_now

# The reference's job parameters.
PV_UV_WINDOW_MS = 5_000
URL_WINDOW_MS = 10_000
TOPN_SIZE_MS, TOPN_SLIDE_MS, TOPN_N = 10_000, 5_000, 2
REPORT_PERIOD_MS = 10_000
TIMER_DELAY_MS = 10_000


def in_file_order(rows: DataFrame) -> DataFrame:
    """Rows of a file source with ``seq``: by file name, then position in the
    file.  Spark packs files into partitions by size, so a row id alone would
    not follow the names."""
    spark = rows.sparkSession
    at = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_piece"),
                     F.monotonically_increasing_id().alias("_row"))
    # written once: the ids below must be the same in both uses, whatever runs again
    path = scratch_path(spark, "ordered")
    at.write.parquet(path)
    at = spark.read.schema(at.schema).parquet(path)
    pieces = at.groupBy("_file", "_piece").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row per file piece
    before = F.sum("_n").over(Window.orderBy("_file", "_piece")) - F.col("_n")
    offsets = pieces.select("_file", "_piece", "_first", before.alias("_before"))
    return (at.join(offsets, ["_file", "_piece"]).withColumn("seq", F.col("_before") + F.col("_row") - F.col("_first"))
            .drop("_file", "_piece", "_row", "_first", "_before"))


def load_clicks(spark: SparkSession, path: str) -> DataFrame:
    """Clicks from ``.csv``/``.txt`` lines or parquet, as the click view."""
    if path.endswith((".csv", ".txt")):
        recs = P.parse_click_csv(in_file_order(read_lines(spark, path)), strict=True)
    else:
        recs = in_file_order(spark.read.parquet(path))
    return from_click_records(recs.select("seq", "user", "url", F.col("timestamp").cast("long")))


def _with_value(c: DataFrame) -> DataFrame:
    return c.withColumn("value", F.col("ms"))


JOBS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "map_user": lambda c: P.map_field(c, "user_id"),
    "user_length": lambda c: P.field_length(c, "user_id", "len"),
    "flatmap": P.flatmap_fields,
    "max_timestamp_running": lambda c: A.max_keep_first_running(_with_value(c), field="value"),
    "maxby_timestamp_running": lambda c: A.max_by_record_running(_with_value(c), field="value"),
    "user_frequency": A.count_by_key,
    "most_active_user_running": A.most_active_running,
    "latest_url_per_user": A.latest_per_key,
    "json_documents": lambda c: c.select("seq", F.to_json(F.create_map("user_id", "url")).alias("doc")),
    "pv_uv": lambda c: W.pv_uv(c, PV_UV_WINDOW_MS),
    "url_count": lambda c: W.url_counts(c, URL_WINDOW_MS).withColumn("text", W.window_count_text()),
    "topn_report": lambda c: report(top_n(W.url_counts(c, TOPN_SIZE_MS, TOPN_SLIDE_MS), TOPN_N)),
    "periodic_pv": lambda c: periodic_counts(c, REPORT_PERIOD_MS).withColumn("msg", pv_report_text()),
    "timers": lambda c: timer_per_event(c, TIMER_DELAY_MS),
    "changelog_count_by_user": lambda c: changelog_count(c, "user_id"),
    "event_strings": P.event_strings,
}

#: Jobs about one user, who is a parameter.
USER_JOBS: dict[str, Callable[[DataFrame, str], DataFrame]] = {
    "filter_user": lambda c, user: P.filter_equals(c, "user_id", user).select("seq", "user_id", "url", "ms"),
    "flatmap_conditional": P.flatmap_conditional,
    "process_conditional": P.process_conditional,
}

#: Jobs of two inputs.
PAIR_JOBS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "co_map_union": lambda a, b: co_map_union(a, b, "ms", "ms", "left:", "right:"),
    "keyed_join": lambda a, b: keyed_join(
        a.select("user_id", "seq", F.col("ms").alias("left_ms")), b.select("user_id", F.col("ms").alias("right_ms")),
        "user_id", F.xxhash64("seq")).withColumn("text", join_text(F.col("user_id"), F.col("left_ms"), F.col("right_ms"))),
}


def word_count(lines: DataFrame) -> DataFrame:
    return P.words(lines, positions=False).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def run_job(spark: SparkSession, name: str, path: str, user: str | None = None, other: str | None = None) -> DataFrame:
    """A batch job over the clicks (or, for ``word_count``, the text lines) at ``path``."""
    if name == "word_count":
        return word_count(read_lines(spark, path))
    if name in USER_JOBS:
        if user is None:
            raise ValueError(f"job {name} needs a user")
        return USER_JOBS[name](load_clicks(spark, path), user)
    if name in PAIR_JOBS:
        if other is None:
            raise ValueError(f"job {name} needs a second click input")
        return PAIR_JOBS[name](load_clicks(spark, path), load_clicks(spark, other))
    return JOBS[name](load_clicks(spark, path))


# ------------------------------------------------------------------ as streams

BUCKET_ROLL_BYTES, BUCKET_IDLE_MS = 1 << 30, 300_000   # the reference's file roll


def stream_clicks(spark: SparkSession, source: str, max_files: int | None = None, watermark: bool = True) -> DataFrame:
    """Clicks as they arrive, with a watermark of no delay on ``ts`` if asked: new files of a folder
    (``.../lines`` of text, or parquet if the folder's name ends so), or the lines of a topic
    (``kafka://host:port[,host:port]/topic``; needs the connector).  A stream has no arrival
    number; ``seq`` is a hash of the record, good for salting only."""
    use_utc(spark)
    if source.startswith("kafka://"):
        servers, _, topic = source[len("kafka://"):].partition("/")
        lines = decode_value(kafka_stream(spark, servers, topic, "earliest"))
    elif source.rstrip("/").endswith("parquet"):
        r = spark.readStream.schema("user string, url string, timestamp long")
        recs = (r.option("maxFilesPerTrigger", str(max_files)) if max_files else r).parquet(source)
        lines = None
    else:
        lines = stream_lines(spark, source, max_files)
    if lines is not None:
        recs = P.parse_click_csv(lines, strict=True, keep=())
    c = from_click_records(recs.select(F.xxhash64("user", "url", "timestamp").alias("seq"), "user", "url", "timestamp"))
    return c.withWatermark("ts", "0 seconds") if watermark else c


@dataclass(frozen=True)
class StreamJob:
    """``build`` makes the streaming frame; ``keys``: update mode, the last row of each key is
    the result; ``batch``: what a micro-batch's rows become; ``clock``: the same with state below
    a folder, given (spark, folder), called with (rows, batch id, watermark)."""
    build: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...] = ()
    batch: Callable[[DataFrame], DataFrame] | None = None
    clock: Callable[[SparkSession, str], Callable[[DataFrame, int, int], DataFrame]] | None = None
    lines: bool = False
    watermark: bool = True


def _due_ticks(spark: SparkSession, folder: str) -> Callable[[DataFrame, int, int], DataFrame]:
    ticks = DueTicks(spark, "periodic_pv", REPORT_PERIOD_MS, key_type="string", path=folder)
    return lambda b, i, wm: ticks.batch(b, i, wm).withColumn("msg", pv_report_text())


def _changelog(spark: SparkSession, folder: str) -> Callable[[DataFrame, int, int], DataFrame]:
    totals = KeyedTotals(spark, "user_id", "changelog", path=folder)
    # within a micro-batch, arrival is by event time, then record
    def step(b: DataFrame, i: int, _: int) -> DataFrame:
        order = F.struct("ms", "seq")
        rows = b.select("user_id", F.row_number().over(Window.partitionBy("user_id").orderBy(order)).alias("nth"))
        before = totals.before(i).select(F.col("user_id").alias("_u"), "total")
        n = rows.join(before, F.col("user_id").eqNullSafe(F.col("_u")), "left").select(
            "user_id", (F.coalesce("total", F.lit(0)) + F.col("nth")).alias("n"))
        totals.write(i, b.groupBy("user_id").agg(F.count(F.lit(1)).alias("total")))
        return n
    return step


STREAM_JOBS: dict[str, StreamJob] = {
    "word_count": StreamJob(word_count, keys=("word",), lines=True),
    "map_user": StreamJob(lambda c: c.select("user_id")),
    "event_strings": StreamJob(lambda c: c.select(P.event_text().alias("event"), P.event_display_text().alias("display"))),
    "flatmap": StreamJob(P.flatmap_fields),
    "count_by_user": StreamJob(lambda c: c.groupBy("user_id").agg(F.count("url").alias("url_count")), keys=("user_id",)),
    "user_frequency": StreamJob(A.count_by_key, keys=("user_id",)),
    "latest_url_per_user": StreamJob(
        lambda c: c.groupBy("user_id").agg(F.max_by("url", F.struct("ms", "seq")).alias("url")), keys=("user_id",)),
    "json_documents": StreamJob(lambda c: c.select(F.to_json(F.create_map("user_id", "url")).alias("doc"))),
    "pv_uv": StreamJob(lambda c: W.pv_uv(c, PV_UV_WINDOW_MS)),
    "url_count": StreamJob(lambda c: W.url_counts(c, URL_WINDOW_MS),
                           batch=lambda b: b.withColumn("text", W.window_count_text())),
    "topn_report": StreamJob(lambda c: W.url_counts(c, TOPN_SIZE_MS, TOPN_SLIDE_MS), batch=lambda b: report(top_n(b, TOPN_N))),
    "periodic_pv": StreamJob(lambda c: c.select("user_id", "ms", "seq", "ts"), clock=_due_ticks),
    "running_count_by_user": StreamJob(lambda c: c.select("user_id", "ms", "seq"), clock=_changelog),
    # its watermark is on the time of firing
    "timers": StreamJob(lambda c: timer_per_event_stream(c, TIMER_DELAY_MS), watermark=False),
}


def run_stream_job(spark: SparkSession, name: str, source: str, folder: str, max_files: int | None = None) -> DataFrame:
    """Run a job as a stream over everything at ``source`` now; its output so far.
    Output, checkpoint and state lie below ``folder``: a later call goes on where this one ended."""
    job = STREAM_JOBS[name]
    stream = stream_lines(spark, source, max_files) if job.lines else stream_clicks(spark, source, max_files, job.watermark)
    res = run_available_now(job.build(stream), f"job_{name}", mode="update" if job.keys else "append", batch_fn=job.batch,
                            batch_fn_clock=job.clock(spark, f"{folder}/state") if job.clock else None,
                            paths=(f"{folder}/out", f"{folder}/checkpoint"))
    return res.last_per_key(list(job.keys)) if job.keys else res.rows()


def click_file_sink(spark: SparkSession, source: str, folder: str, max_files: int | None = None) -> str:
    """Clicks written as text records by event hour, in files that roll by size and idle time;
    the folder of the files (``sinks.rolling.read_rolled`` reads them)."""
    rows = stream_clicks(spark, source, max_files).select("seq", P.event_text().alias("value"), hour_bucket("ms").alias("bucket"))
    q = rolled_files_stream(rows, f"{folder}/out", f"{folder}/checkpoint", "seq", BUCKET_ROLL_BYTES, BUCKET_IDLE_MS)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return f"{folder}/out"


def click_upsert_sink(spark: SparkSession, source: str, folder: str, max_files: int | None = None) -> DataFrame:
    """Clicks merged into a snapshot user -> url, later event times win; the snapshot."""
    rows = stream_clicks(spark, source, max_files).select("user_id", "url", F.struct("ms", "seq").alias("at"))
    q = upsert_stream(rows, f"{folder}/snapshot", f"{folder}/checkpoint", ["user_id"], "at")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_snapshot(spark, f"{folder}/snapshot").select("user_id", "url")


def click_topic_sink(spark: SparkSession, source: str, servers: str, topic: str, folder: str):
    """Clicks as JSON records to a topic (needs the connector); the running query."""
    return write_kafka(click_payload(stream_clicks(spark, source)), servers, topic, f"{folder}/checkpoint")
