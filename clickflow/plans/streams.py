"""Streaming queries: the same operator functions as the batch queries, run
by Structured Streaming over an event-time-ordered replay of the driver
tables (``availableNow``, several micro-batches), output collected as a
table.

Append-mode windowed results only contain windows closed by the final
watermark (= the largest event time), so their oracles keep windows with
``window_end <= max(ms)``.  Update-mode results are reduced to each key's
last emitted row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators import aggregates as A
from clickflow.operators import transforms as P
from clickflow.operators import windows as W
from clickflow.operators.combine import co_map_union as _co_map, hot_keys, join_text, salt_inputs
from clickflow.operators.ranking import report, top_n
from clickflow.operators.timers import pv_report_text, timer_per_event_stream
from clickflow.plans import batch as B
from clickflow.plans.registry import CK, REGISTRY, register
from clickflow.sinks import hour_bucket, stream_text_files
from clickflow.sinks.rolling import read_rolled, rolled_files_stream
from clickflow.session import scratch_path, use_utc
from clickflow.functions.strings import json_object
from clickflow.sinks.upsert import read_snapshot, upsert_stream
from clickflow.sources.tables import click_view, table, table_state
from clickflow.sources.views import register_view
from clickflow.streaming.due_ticks import DueTicks
from clickflow.streaming.history_join import HistoryJoin, tagged
from clickflow.streaming.keyed_totals import KeyedTotals, changelog_batch
from clickflow.streaming.replay import events_replay, write_replay
from clickflow.streaming.runner import run_available_now

CHUNKS = 4                # micro-batches of a replay: equal-width time slices, whatever the size
FILES_PER_CHUNK = 2       # least files per micro-batch; their number grows with the rows
WATERMARK_DELAY = "0 seconds"   # bounded out-of-orderness 0 (reference)
LATE_CHUNK_ORDER = [0, 2, 1, 3]  # stream_late_data: slice 1 arrives after slice 2

_CLOSED = "(SELECT max(epoch_us(ts)//1000) FROM events)"

def click_stream(spark: SparkSession, sf_dir: str, chunk_order=None) -> DataFrame:
    use_utc(spark)
    r = events_replay(spark, sf_dir, CHUNKS, FILES_PER_CHUNK, chunk_order)
    return click_view(r.stream(spark)).withWatermark("ts", WATERMARK_DELAY)


def _sql(name: str) -> str:
    return REGISTRY[name].sql


def _closed_sql(name: str, end: str = "window_end") -> str:
    """The batch oracle restricted to windows closed by the final watermark."""
    return f"SELECT * FROM ({_sql(name)}) q WHERE {end} <= {_CLOSED}"


# -------------------------------------------------------- stateless streams

@register("stream_process_conditional", _sql("process_conditional"), streaming=True)
def stream_process_conditional(spark, sf_dir):
    """P10 + P11 on a stream: stateless process function, append mode."""
    s = P.process_conditional(click_stream(spark, sf_dir), B.FILTER_USER)
    return run_available_now(s, "stream_process_conditional").rows()


@register("stream_co_map_union", _sql("co_map_union"), streaming=True)
def stream_co_map_union(spark, sf_dir):
    """U1 on two streams (int and long sources) unioned by name."""
    n = write_replay(spark, table(spark, sf_dir, "nation"), "n_nationkey", "nation", 2, 1,
                     cache_key=table_state(spark, sf_dir, "nation"))
    c = write_replay(spark, table(spark, sf_dir, "customer"), "c_custkey", "customer", 2, 1,
                     cache_key=table_state(spark, sf_dir, "customer"))
    s = _co_map(n.stream(spark), c.stream(spark), "n_nationkey", "c_custkey")
    return run_available_now(s, "stream_co_map_union").rows()


@register("stream_file_sink", _sql("file_sink_roundtrip"), streaming=True)
def stream_file_sink(spark, sf_dir):
    """K3: streaming row-format text sink, bucketed by event hour; parts roll by
    exact bytes, across micro-batches, and when a bucket was idle."""
    s = click_stream(spark, sf_dir).select("seq", P.event_text().alias("value"), hour_bucket("ms").alias("bucket"))
    out, ckpt = scratch_path(spark, "files", "stream"), scratch_path(spark, "ckpt", "stream_file_sink")
    q = rolled_files_stream(s, out, ckpt, "seq", B.ROLL_BYTES, B.IDLE_MS)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_rolled(spark, out).select("value", "bucket")


@register("stream_document_sink", _sql("json_documents").replace("SELECT seq, ", "SELECT "), streaming=True)
def stream_document_sink(spark, sf_dir):
    """K6: one {user: url} document per click, written by a stream as JSON
    lines, bucketed by event hour, and read back."""
    c = click_stream(spark, sf_dir)
    docs = c.select(json_object(F.col("user_id"), F.col("url")).alias("value"), hour_bucket("ms").alias("bucket"))
    out = scratch_path(spark, "files", "documents")
    q = stream_text_files(docs, out, scratch_path(spark, "ckpt", "stream_document_sink"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.format("text").load(out).select(F.col("value").alias("doc"))


@register("upsert_snapshot", _sql("latest_url_per_user"), streaming=True)
def upsert_snapshot(spark, sf_dir):
    """K5: the stream's clicks merged into a versioned snapshot, user -> url,
    later clicks win; the newest version is read back."""
    rows = click_stream(spark, sf_dir).select("user_id", "url", F.struct("ms", "seq").alias("at"))
    root = scratch_path(spark, "snapshot")
    q = upsert_stream(rows, root, scratch_path(spark, "ckpt", "upsert_snapshot"), ["user_id"], "at")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_snapshot(spark, root).select("user_id", "url")


# ------------------------------------------------------- update-mode keyed

@register("stream_word_count", _sql("word_count"), streaming=True)
def stream_word_count(spark, sf_dir):
    """S2 + P7 + A2: streaming word count over document text files, update
    mode; the final row per word is the total."""
    docs = table(spark, sf_dir, "documents")
    r = write_replay(spark, docs, "doc_id", "documents", CHUNKS, FILES_PER_CHUNK, fmt="text",
                     value_col="text", cache_key=(*table_state(spark, sf_dir, "documents"), CHUNKS, FILES_PER_CHUNK))
    counts = P.words(r.stream(spark), "value", positions=False).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return run_available_now(counts, "stream_word_count", mode="update").last_per_key(["word"])


@register("stream_count_by_user", _sql("sql_count_by_user"), streaming=True)
def stream_count_by_user(spark, sf_dir):
    """A7 on a stream: SQL COUNT(url) GROUP BY user over a streaming view,
    update mode (the reference prints it as a changelog)."""
    register_view(click_stream(spark, sf_dir), "StreamEventTable")
    q = spark.sql("SELECT user_id, COUNT(url) AS url_count FROM StreamEventTable GROUP BY user_id")
    return run_available_now(q, "stream_count_by_user", mode="update").last_per_key(["user_id"])


@register("stream_latest_url_per_user", _sql("latest_url_per_user"), streaming=True)
def stream_latest_url_per_user(spark, sf_dir):
    """K5 on a stream: keyed upsert held in the state store (one row per
    user), update mode."""
    s = A.latest_per_key(click_stream(spark, sf_dir), "user_id", "url")
    return run_available_now(s, "stream_latest_url_per_user", mode="update").last_per_key(["user_id"])


@register("stream_max_by_user", _sql("max_by_user"), streaming=True)
def stream_max_by_user(spark, sf_dir):
    """A3 on a stream: keyBy(user).max(value) keeping the first record's other
    fields, update mode (state: one row per user)."""
    s = A.max_keep_first(click_stream(spark, sf_dir), "user_id", "value", "url")
    return run_available_now(s, "stream_max_by_user", mode="update").last_per_key(["user_id"])


@register("stream_maxby_user", _sql("maxby_user"), streaming=True)
def stream_maxby_user(spark, sf_dir):
    """A4 on a stream: keyBy(user).maxBy(value), update mode."""
    s = A.max_by_record(click_stream(spark, sf_dir))
    return run_available_now(s, "stream_maxby_user", mode="update").last_per_key(["user_id"])


@register("stream_most_active_user", _sql("most_active_user"), streaming=True)
def stream_most_active_user(spark, sf_dir):
    """A6 on a stream: per-user counts in update mode; each micro-batch ranks
    only the users it updated.  Counts never decrease, so the best over all
    batches' winners is the current most active user (the newer click wins
    ties); no global state key, no per-row reduce."""
    per_user = click_stream(spark, sf_dir).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("c"), F.max("seq").alias("q"))
    best = lambda b: b.agg(F.max(F.struct("c", "q", "user_id")).alias("_b")).select(
        F.col("_b.user_id").alias("user_id"), F.col("_b.c").alias("cnt"), F.col("_b.q").alias("q"))
    res = run_available_now(per_user, "stream_most_active_user", mode="update", batch_fn=best)
    top = res.batches().agg(F.max(F.struct("cnt", "q", "user_id")).alias("_b"))
    return top.select(F.col("_b.user_id").alias("user_id"), F.col("_b.cnt").alias("cnt"))


# ------------------------------------------------------ append-mode windows

@register("stream_url_count_tumbling", _closed_sql("url_count_tumbling"), streaming=True)
def stream_url_count_tumbling(spark, sf_dir):
    """W2 + E1 + E2 on a stream: closed tumbling windows, append mode."""
    s = W.url_counts(click_stream(spark, sf_dir), B.TUMBLE_MS)
    return run_available_now(s, "stream_url_count_tumbling").rows()


@register("stream_url_count_sliding", _closed_sql("url_count_sliding"), streaming=True)
def stream_url_count_sliding(spark, sf_dir):
    """W3 on a stream: closed sliding windows, append mode."""
    s = W.url_counts(click_stream(spark, sf_dir), B.SLIDE_SIZE_MS, B.SLIDE_STEP_MS)
    return run_available_now(s, "stream_url_count_sliding").rows()


@register("stream_pv_uv_tumbling", _closed_sql("pv_uv_tumbling", f"window_start + {B.TUMBLE_MS}"), streaming=True)
def stream_pv_uv_tumbling(spark, sf_dir):
    """A9 + A10 on a stream: two chained append-mode aggregations."""
    s = W.pv_uv(click_stream(spark, sf_dir), B.TUMBLE_MS)
    return run_available_now(s, "stream_pv_uv_tumbling").rows()


@register("stream_url_count_tumbling_10s", _closed_sql("url_count_tumbling_10s"), streaming=True)
def stream_url_count_tumbling_10s(spark, sf_dir):
    """W2 on a stream at the reference's 10 s window, with the record text."""
    s = W.url_counts(click_stream(spark, sf_dir), B.REF_URL_WINDOW_MS)
    return run_available_now(s, "stream_url_count_tumbling_10s").rows().withColumn("text", W.window_count_text())


@register("stream_pv_uv_tumbling_5s", _closed_sql("pv_uv_tumbling_5s", f"window_start + {B.REF_PV_UV_MS}"),
          streaming=True)
def stream_pv_uv_tumbling_5s(spark, sf_dir):
    """A9 + A10 on a stream at the reference's 5 s window."""
    s = W.pv_uv(click_stream(spark, sf_dir), B.REF_PV_UV_MS)
    return run_available_now(s, "stream_pv_uv_tumbling_5s").rows()


@register("stream_topn_sliding", _closed_sql("topn_sliding"), streaming=True)
def stream_topn_sliding(spark, sf_dir):
    """T2 + E7 on a stream: windows close once (append mode), so every
    window's complete counts arrive in one micro-batch; each batch is ranked
    with the batch top-N (partial WindowGroupLimit, no per-window list)."""
    counts = W.url_counts(click_stream(spark, sf_dir), B.SLIDE_SIZE_MS, B.SLIDE_STEP_MS)
    res = run_available_now(counts, "stream_topn_sliding",
                            batch_fn=lambda b: top_n(b, B.TOP_N).select("window_end", "url", "cnt", "rk"))
    return res.rows()


@register("stream_topn_report", _closed_sql("topn_report"), streaming=True)
def stream_topn_report(spark, sf_dir):
    """T3 on a stream: each closed window's ranking rendered as text, one
    report per window (windows close once, in one micro-batch)."""
    counts = W.url_counts(click_stream(spark, sf_dir), B.SLIDE_SIZE_MS, B.SLIDE_STEP_MS)
    res = run_available_now(counts, "stream_topn_report", batch_fn=lambda b: report(top_n(b, B.TOP_N)))
    return res.rows()


@register("stream_late_data", f"""WITH {CK},
k AS (SELECT ms, CAST(floor((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) * {CHUNKS}
      / ((SELECT max(epoch_us(ts)) - min(epoch_us(ts)) FROM events) + 1)) AS INTEGER) AS chunk FROM ck),
w AS (SELECT (ms // {B.TUMBLE_MS}) * {B.TUMBLE_MS} AS window_start, count(*) AS cnt FROM k
      WHERE chunk <> {LATE_CHUNK_ORDER[2]} GROUP BY 1)
SELECT * FROM w WHERE window_start + {B.TUMBLE_MS} <= {_CLOSED}""", streaming=True)
def stream_late_data(spark, sf_dir):
    """A replay whose second time slice arrives after the third.  With
    lateness judged against the current watermark (as the reference does),
    every row of the delayed slice is dropped; counts cover the rest."""
    s = click_stream(spark, sf_dir, LATE_CHUNK_ORDER)
    g = s.groupBy(W.event_window(B.TUMBLE_MS).alias("window")).agg(F.count(F.lit(1)).alias("cnt"))
    g = g.select(F.unix_millis(F.col("window.start")).alias("window_start"), "cnt")
    res = run_available_now(g, "stream_late_data",
                            conf={"spark.sql.streaming.statefulOperator.allowMultiple": "false"})
    return res.rows()


@register("stream_element_watermark", f"""WITH {CK},
k AS (SELECT seq, user_id, ms, CAST(floor((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) * {CHUNKS}
      / ((SELECT max(epoch_us(ts)) - min(epoch_us(ts)) FROM events) + 1)) AS INTEGER) AS chunk FROM ck),
m AS (SELECT chunk, max(ms) AS mx FROM k GROUP BY chunk),
w AS (SELECT c.chunk, coalesce((SELECT max(mx) FROM m WHERE m.chunk < c.chunk), 0) AS watermark_ms
      FROM (SELECT DISTINCT chunk FROM k) c)
SELECT k.seq, k.user_id, k.ms, w.watermark_ms FROM k JOIN w ON k.chunk = w.chunk""", streaming=True)
def stream_element_watermark(spark, sf_dir):
    """Every click with the watermark current when it was processed
    (the largest event time of earlier micro-batches, delay 0)."""
    s = click_stream(spark, sf_dir).select("seq", "user_id", "ms", "ts")
    res = run_available_now(s, "stream_element_watermark", batch_fn_clock=lambda b, _, wm: b.select(
        "seq", "user_id", "ms", F.lit(wm).cast("long").alias("watermark_ms")))
    return res.rows()


@register("stream_late_rows", f"""WITH {CK},
k AS (SELECT seq, user_id, ms, CAST(floor((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) * {CHUNKS}
      / ((SELECT max(epoch_us(ts)) - min(epoch_us(ts)) FROM events) + 1)) AS INTEGER) AS chunk FROM ck),
o AS (SELECT unnest({LATE_CHUNK_ORDER}) AS chunk, unnest(range({CHUNKS})) AS place),
m AS (SELECT o.place, max(k.ms) AS mx FROM o LEFT JOIN k USING (chunk) GROUP BY o.place),
w AS (SELECT o.chunk, coalesce((SELECT max(mx) FROM m WHERE m.place < o.place), 0) AS wm FROM o)
SELECT seq, user_id, ms, w.wm AS watermark_ms, (ms // {B.TUMBLE_MS}) * {B.TUMBLE_MS} + {B.TUMBLE_MS} <= w.wm AS late
FROM k JOIN w USING (chunk)""", streaming=True)
def stream_late_rows(spark, sf_dir):
    """The replay whose second time slice arrives late, each micro-batch split
    against the watermark it runs under.  Late rows go to a side table, batch by batch,
    on-time rows to the main one; together they are the input."""
    side = scratch_path(spark, "side", "stream_late_rows")

    def split(batch, batch_id, wm):
        on_time, late = W.split_late(batch.select("seq", "user_id", "ms").withColumn("watermark_ms", F.lit(wm).cast("long")), wm, B.TUMBLE_MS)
        late.write.mode("overwrite").parquet(f"{side}/batch_id={batch_id}")
        return on_time

    res = run_available_now(click_stream(spark, sf_dir, LATE_CHUNK_ORDER).select("seq", "user_id", "ms", "ts"),
                            "stream_late_rows", batch_fn_clock=split)
    on_time = res.rows()
    late = spark.read.schema(on_time.schema).parquet(side).select(*on_time.columns)
    return on_time.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))


@register("stream_progress", f"""WITH {CK},
k AS (SELECT ms, CAST(floor((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) * {CHUNKS}
      / ((SELECT max(epoch_us(ts)) - min(epoch_us(ts)) FROM events) + 1)) AS INTEGER) AS chunk FROM ck),
m AS (SELECT chunk, count(*) AS n, max(ms) AS mx FROM k GROUP BY chunk)
SELECT CAST(chunk AS BIGINT) AS batch_id, n AS num_input_rows,
       coalesce((SELECT max(mx) FROM m m2 WHERE m2.chunk < m.chunk), 0) AS watermark_ms FROM m
UNION ALL SELECT {CHUNKS}, 0, (SELECT max(mx) FROM m)""", streaming=True)
def stream_progress(spark, sf_dir):
    """Per micro-batch input rows and event-time watermark (epoch ms) of
    a windowed count over the click replay (from the query progress)."""
    s = W.url_counts(click_stream(spark, sf_dir), B.TUMBLE_MS)
    res = run_available_now(s, "stream_progress")
    rows = []
    for p in res.progress:
        wm = (p.get("eventTime") or {}).get("watermark")
        rows.append((int(p["batchId"]), int(p.get("numInputRows", 0)), wm))
    df = spark.createDataFrame(rows, "batch_id long, num_input_rows long, watermark string")
    return df.select("batch_id", "num_input_rows",
                     F.unix_millis(F.to_timestamp("watermark")).alias("watermark_ms"))


# -------------------------------------------------------------- two streams

@register("stream_keyed_join", _sql("keyed_join"), streaming=True)
def stream_keyed_join(spark, sf_dir):
    """J1 on two streams: clicks and the users' first-seen records, inner
    join on user over full history.  Any later record may meet any earlier
    one, so a stateful join would hold nearly all clicks; their history is kept
    as written tables instead (``streaming.history_join``)."""
    use_utc(spark)
    c = B.clicks(spark, sf_dir)
    first = write_replay(spark, B.first_seen(c), "right_ms", "first_seen", 2, 1,
                         cache_key=("first_seen", *table_state(spark, sf_dir, "events")))
    # users with over 5% of all clicks (known from history: the table) are
    # salted so that a batch's join spreads them over several partitions; the list
    # has at most 20 rows, materialized once
    hot = spark.createDataFrame(hot_keys(c.select("user_id"), "user_id", 0.05).collect(), "user_id long, _n long")

    def join(left, right):
        left, right = salt_inputs(left, right, "user_id", F.xxhash64("seq"), hot, buckets=8)
        j = left.join(right, ["user_id", "_salt"]).where("right_ms <= left_ms")
        return j.select("user_id", "seq", "left_ms", "right_ms",
                        join_text(F.col("user_id"), F.col("left_ms"), F.col("right_ms")).alias("text"))

    left = click_stream(spark, sf_dir).select("user_id", "seq", F.col("ms").alias("left_ms"))
    history = HistoryJoin(spark, "stream_keyed_join", ["user_id", "seq", "left_ms"], ["user_id", "right_ms"], join)
    return run_available_now(tagged(left, first.stream(spark)), "stream_keyed_join", batch_fn_id=history.batch).rows()


# -------------------------------------------------- stateful processors

@register("stream_changelog_count", _sql("changelog_count"), streaming=True)
def stream_changelog_count(spark, sf_dir):
    """K8 on a stream: changelog of COUNT per url.  Five keys, so keyed state
    would use five tasks per micro-batch; each micro-batch instead runs the
    skew-safe prefix scan and adds per-key totals carried in a versioned
    table (``streaming.keyed_totals``)."""
    s = click_stream(spark, sf_dir).select("seq", "url")
    totals = KeyedTotals(spark, "url", "stream_changelog_count")
    res = run_available_now(s, "stream_changelog_count",
                            batch_fn_id=lambda b, i: changelog_batch(b, i, totals))
    return res.rows().select("seq", "pos", "op", "url", "n")


@register("stream_timer_per_event", _sql("timer_per_event"), streaming=True)
def stream_timer_per_event(spark, sf_dir):
    """E5 on a stream: arrivals plus one timer row per (user, ts + 10 s) once
    the watermark passes it, as an append-mode aggregation (no keyed state;
    ``processors.TimerPerEvent`` is the keyed-processor form)."""
    use_utc(spark)
    r = events_replay(spark, sf_dir, CHUNKS, FILES_PER_CHUNK)
    s = timer_per_event_stream(click_view(r.stream(spark)), B.TIMER_DELAY_MS, "user_id")
    return run_available_now(s, "stream_timer_per_event").rows()


@register("stream_periodic_user_pv", _sql("periodic_user_pv"), streaming=True)
def stream_periodic_user_pv(spark, sf_dir):
    """E8 + E10 on a stream: cumulative PV per user every period, as a table of
    due ticks (``streaming.due_ticks``): no keyed state, no Python; the
    ``processors.PeriodicCount`` processor is the keyed form."""
    ticks = DueTicks(spark, "stream_periodic_user_pv", B.REPORT_PERIOD_MS)
    s = click_stream(spark, sf_dir).select("user_id", "ms", "seq", "ts")
    res = run_available_now(s, "stream_periodic_user_pv", batch_fn_clock=ticks.batch)
    ticks.close()
    return res.rows().withColumn("msg", pv_report_text("user_id"))
