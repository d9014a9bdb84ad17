"""Batch queries over the driver tables, one per operator of the survey.

Window sizes and report periods are parameters; the reference's defaults
(5 s, 10 s, 10 s/5 s, 10 s) leave about one click per window on the driver's
month of events, so registered queries use hour/day scales.  Every query runs
over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions.strings import java_trim
from clickflow.functions.timefmt import datetime_text, sql_timestamp_text
from clickflow.operators import aggregates as A
from clickflow.operators import transforms as P
from clickflow.operators import windows as W
from clickflow.operators.changelog import changelog_count as _changelog
from clickflow.operators.combine import co_map_union as _co_map, join_text, keyed_join as _join
from clickflow.operators.ranking import top_n, report
from clickflow.operators.scan import adaptive_block, expanded_scan, prefix_scan
from clickflow.operators.timers import periodic_counts, pv_report_text, timer_per_event as _timers
from clickflow.operators.udf import PvUv, LengthMapper, aggregate_with, flatmap_udtf, map_rich
from clickflow.plans.registry import CK, register, sql_event_text, sql_java_words, sql_ts_text
from clickflow.schema import DAY_MS, HOUR_MS
from clickflow.session import scratch_path
from clickflow.sinks import hour_bucket, json_documents as _json_docs
from clickflow.sinks.rolling import read_rolled, write_rolled
from clickflow.sources import clicks, document_lines, register_view, sql_over, table
from clickflow.sources.text import read_lines
from clickflow.sources.kafka import click_payload, decode_value, encode_records

# Parameters of the registered queries.
FILTER_USER = 13          # the user singled out by filter / flatMap / process
TOP_N = 2                 # reference: top 2 urls per window
TUMBLE_MS = HOUR_MS       # tumbling window (reference: 5 s / 10 s)
SLIDE_SIZE_MS = 2 * HOUR_MS   # sliding window size (reference: 10 s)
SLIDE_STEP_MS = HOUR_MS       # sliding step (reference: 5 s)
REPORT_PERIOD_MS = DAY_MS     # periodic PV report (reference: 10 s)
TIMER_DELAY_MS = 10_000       # per-event timer delay (reference value)
ROLL_BYTES = 1 << 30          # text sink part-file roll size (reference value: 1 GiB)
IDLE_MS = 300_000             # text sink roll of a bucket without input (reference value: 5 min)
SEQ_BLOCK = 4096              # smallest prefix-scan block on seq (grows as sqrt of the table's rows)
DOC_BLOCK = 64            # smallest prefix-scan block on doc_id for token scans
DOC_BYTES = 512           # about an eighth of a document: blocks wider than the square root, so fewer summaries


def _seq_block(c: DataFrame):
    return adaptive_block(c, "seq", SEQ_BLOCK)


# ---------------------------------------------------------------- word count

def _tokens(documents: DataFrame) -> DataFrame:
    """(doc_id, at, word, _blk): ``at`` holds the line and the position in it, for one sort column."""
    t = P.words(document_lines(documents, ("_blk",)), "line", keep=("doc_id", "line_no", "_blk"))
    at = F.shiftleft(F.col("line_no").cast("long"), 32).bitwiseOR(F.col("pos").cast("long"))
    return t.select("doc_id", at.alias("at"), F.coalesce("word", F.lit("")).alias("word"), "_blk")


@register("word_count", f"""
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
toks AS (SELECT unnest({sql_java_words('line')}) AS word FROM lines)
SELECT word, count(*) AS n FROM toks GROUP BY word""")
def word_count(spark, sf_dir):
    """S1 + P7 + G1 + A1: batch word count over whole document texts."""
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split(F.col("text"), "\n")).alias("line"))
    return P.words(lines, "line", positions=False).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@register("word_count_text", f"""
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
toks AS (SELECT unnest({sql_java_words('line')}) AS word FROM lines)
SELECT word, count(*) AS n FROM toks GROUP BY word""")
def word_count_text(spark, sf_dir):
    """The documents written as text lines, and counted from those files."""
    path = scratch_path(spark, "files", "words")
    table(spark, sf_dir, "documents").where("text is not null").select("text").write.option("lineSep", "\n").text(path)
    return P.words(read_lines(spark, path), positions=False).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@register("word_count_running", f"""
WITH l0 AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM l0),
t0 AS (SELECT doc_id, line_no, {sql_java_words('line')} AS ws FROM lines),
toks AS (SELECT doc_id, line_no, unnest(range(len(ws))) AS pos, unnest(ws) AS word FROM t0)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(pos AS INTEGER) AS pos, word,
       count(*) OVER (PARTITION BY word ORDER BY doc_id, line_no, pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n
FROM toks""")
def word_count_running(spark, sf_dir):
    """A2: running count per word in (doc, line, position) order."""
    docs = table(spark, sf_dir, "documents")
    blk = adaptive_block(docs, "doc_id", DOC_BLOCK, DOC_BYTES)
    t = expanded_scan(docs, _tokens, ["word"], ["doc_id", "at"], blk, {"n": ("sum", F.lit(1).cast("long"))})
    return t.select("doc_id", F.shiftright("at", 32).cast("int").alias("line_no"),
                    F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("pos"), "word", "n")


# ---------------------------------------------------------- row transforms

@register("map_user", f"WITH {CK} SELECT seq, user_id FROM ck")
def map_user(spark, sf_dir):
    """Map each click to its user."""
    return P.map_field(clicks(spark, sf_dir), "user_id")


@register("user_length", f"WITH {CK} SELECT seq, CAST(length(url) AS INTEGER) AS len FROM ck")
def user_length(spark, sf_dir):
    """String length of a field."""
    return P.field_length(clicks(spark, sf_dir), "url", "len")


@register("filter_user", f"WITH {CK} SELECT seq, user_id, url, ms FROM ck WHERE user_id = {FILTER_USER}")
def filter_user(spark, sf_dir):
    """equality filter (pushed to the parquet scan)."""
    return P.filter_equals(clicks(spark, sf_dir), "user_id", FILTER_USER).select("seq", "user_id", "url", "ms")


@register("event_to_string", f"""WITH {CK}
SELECT seq, {sql_event_text()} AS event,
       {sql_event_text(ts="strftime(ts, '%Y-%m-%d %H:%M:%S')")} AS display FROM ck""")
def event_to_string(spark, sf_dir):
    """Record -> display string (raw ms and formatted time)."""
    return P.event_strings(clicks(spark, sf_dir))


@register("sql_project", f"WITH {CK} SELECT seq, url, user_id FROM ck")
def sql_project(spark, sf_dir):
    """S6 + P6: SQL projection with reordered columns over an anonymous table."""
    return sql_over(spark, "SELECT seq, url, user_id FROM {clicks}", clicks=clicks(spark, sf_dir))


@register("sql_filter_user", f"WITH {CK} SELECT seq, user_id, url, ms FROM ck WHERE user_id = {FILTER_USER}")
def sql_filter_user(spark, sf_dir):
    """S7 + F2: SQL WHERE over a named temporary view."""
    register_view(clicks(spark, sf_dir), "EventTable")
    return spark.sql(f"SELECT seq, user_id, url, ms FROM EventTable WHERE user_id = {FILTER_USER}")


@register("flatmap_fields", f"""WITH {CK}
SELECT seq, CAST(unnest(range(2)) AS INTEGER) AS pos,
       unnest([CAST(user_id AS VARCHAR), CAST(ms AS VARCHAR)]) AS v FROM ck""")
def flatmap_fields(spark, sf_dir):
    """Each click emits user then timestamp."""
    return P.flatmap_fields(clicks(spark, sf_dir))


@register("flatmap_conditional", f"""WITH {CK}, a AS (
SELECT seq, CASE WHEN user_id = {FILTER_USER}
  THEN [url, CAST(ms AS VARCHAR), CAST(user_id AS VARCHAR), CAST(ms AS VARCHAR)]
  ELSE [CAST(user_id AS VARCHAR), CAST(ms AS VARCHAR)] END AS arr FROM ck)
SELECT seq, CAST(unnest(range(len(arr))) AS INTEGER) AS pos, unnest(arr) AS v FROM a""")
def flatmap_conditional(spark, sf_dir):
    """P9 + F3: conditional extra rows in a flatMap."""
    return P.flatmap_conditional(clicks(spark, sf_dir), FILTER_USER)


@register("udtf_flatmap_conditional", f"""WITH {CK}, a AS (
SELECT seq, CASE WHEN user_id = {FILTER_USER}
  THEN [url, CAST(ms AS VARCHAR), CAST(user_id AS VARCHAR), CAST(ms AS VARCHAR)]
  ELSE [CAST(user_id AS VARCHAR), CAST(ms AS VARCHAR)] END AS arr FROM ck)
SELECT seq, CAST(unnest(range(len(arr))) AS INTEGER) AS pos, unnest(arr) AS v FROM a""")
def udtf_flatmap_conditional(spark, sf_dir):
    """The conditional flatMap as a vectorized Python table function."""
    fn = flatmap_udtf(FILTER_USER)
    return fn(clicks(spark, sf_dir).select("seq", "user_id", "url", "ms").asTable())


@register("process_conditional", f"""WITH {CK}, a AS (
SELECT seq, CASE WHEN user_id = {FILTER_USER}
  THEN [CAST(user_id AS VARCHAR) || 'clicks' || url, {sql_event_text()}]
  ELSE [{sql_event_text()}] END AS arr FROM ck)
SELECT seq, CAST(unnest(range(len(arr))) AS INTEGER) AS pos, unnest(arr) AS v FROM a""")
def process_conditional(spark, sf_dir):
    """P10: process function with a conditional side message."""
    return P.process_conditional(clicks(spark, sf_dir), FILTER_USER)


_PARSED_SQL = f"WITH {CK} SELECT seq, CAST(user_id AS VARCHAR) AS user, url, ms AS timestamp FROM ck"


@register("parse_click_csv", _PARSED_SQL)
def parse_click_csv(spark, sf_dir):
    """P5: render clicks as ``user,url, ms`` lines and parse them back
    (strict: a malformed line fails the job)."""
    return P.parse_click_csv(P.click_csv_lines(clicks(spark, sf_dir)), strict=True)


@register("parse_click_rejects", f"""WITH {CK}, l AS (SELECT seq, CASE seq % 3
  WHEN 0 THEN CAST(user_id AS VARCHAR) || ',' || url
  WHEN 1 THEN CAST(user_id AS VARCHAR) || ',' || url || ', x' || CAST(ms AS VARCHAR)
  ELSE CAST(user_id AS VARCHAR) || ',' || url || ', ' || CAST(ms AS VARCHAR) END AS value,
  CAST(user_id AS VARCHAR) AS "user", url FROM ck)
SELECT seq, "user", url FROM l WHERE seq % 3 < 2""")
def parse_click_rejects(spark, sf_dir):
    """P5 tolerant: of lines without a time, with a bad one and with a good one
    the rejected rows."""
    user, url, ms = F.col("user_id").cast("string"), F.col("url"), F.col("ms").cast("string")
    kind = F.pmod(F.col("seq"), F.lit(3))
    line = (F.when(kind == 0, F.concat(user, F.lit(","), url)).when(kind == 1, F.concat(user, F.lit(","), url, F.lit(", x"), ms))
            .otherwise(F.concat(user, F.lit(","), url, F.lit(", "), ms)))
    lines = clicks(spark, sf_dir).select("seq", line.alias("value"))
    return P.split_rejects(P.parse_click_csv(lines, strict=False))[1].select("seq", "user", "url")


@register("kafka_decode", _PARSED_SQL)
def kafka_decode(spark, sf_dir):
    """Kafka records (binary value) -> string -> click."""
    recs = encode_records(P.click_csv_lines(clicks(spark, sf_dir)), "seq", "value", "seq")
    return P.parse_click_csv(decode_value(recs, "seq"), strict=True)


@register("kafka_payload", f"""WITH {CK}
SELECT seq, CAST(user_id AS VARCHAR) AS key,
  '{{"user":"' || CAST(user_id AS VARCHAR) || '","url":"' || url || '","timestamp":' || CAST(ms AS VARCHAR) || '}}'
  AS value FROM ck""")
def kafka_payload(spark, sf_dir):
    """K4: producer record (key, JSON value) per click."""
    return click_payload(clicks(spark, sf_dir))


@register("json_documents", f"""WITH {CK}
SELECT seq, '{{"' || CAST(user_id AS VARCHAR) || '":"' || url || '"}}' AS doc FROM ck""")
def json_documents(spark, sf_dir):
    """K6: one {user: url} document per click."""
    return _json_docs(clicks(spark, sf_dir))


@register("latest_url_per_user", f"""WITH {CK}
SELECT user_id, url FROM (SELECT user_id, url,
  row_number() OVER (PARTITION BY user_id ORDER BY ms DESC, seq DESC) AS rn FROM ck) WHERE rn = 1""")
def latest_url_per_user(spark, sf_dir):
    """K5: keyed upsert (hash set user -> url), later writes win."""
    return A.latest_per_key(clicks(spark, sf_dir), "user_id", "url")


@register("file_sink_roundtrip", f"""WITH {CK}
SELECT {sql_event_text()} AS value, strftime(ts, '%Y-%m-%d--%H') AS bucket FROM ck""")
def file_sink_roundtrip(spark, sf_dir):
    """K3: write record strings as bucketed, rolled text files; read back."""
    c = clicks(spark, sf_dir)
    out = scratch_path(spark, "files", "roundtrip")
    write_rolled(c.select("seq", P.event_text().alias("value"), hour_bucket("ms").alias("bucket")), out, "seq", ROLL_BYTES)
    return read_rolled(spark, out).select("value", "bucket")


# ------------------------------------------------------------- aggregates

@register("max_by_user", f"""WITH {CK}
SELECT user_id, arg_min(url, seq) AS url, max(value) AS value FROM ck GROUP BY user_id""")
def max_by_user(spark, sf_dir):
    """A3 final: max of one field, other fields from the key's first record."""
    return A.max_keep_first(clicks(spark, sf_dir), "user_id", "value", "url")


@register("max_by_user_running", f"""WITH {CK}
SELECT seq, user_id,
  first_value(url) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS url,
  max(value) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM ck""")
def max_by_user_running(spark, sf_dir):
    """A3 running: keyBy(user).max(field)."""
    c = clicks(spark, sf_dir)
    return A.max_keep_first_running(c, block=_seq_block(c))


@register("maxby_user", f"""WITH {CK}
SELECT user_id, seq, url, value FROM (SELECT user_id, seq, url, value,
  row_number() OVER (PARTITION BY user_id ORDER BY value DESC, seq) AS rn FROM ck) WHERE rn = 1""")
def maxby_user(spark, sf_dir):
    """A4 final: the record with the max field (first on ties)."""
    return A.max_by_record(clicks(spark, sf_dir))


@register("maxby_user_running", f"""WITH {CK}, r AS (
SELECT seq, user_id, max({{'v': value, 'ns': -seq, 'u': url}}) OVER (PARTITION BY user_id ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b FROM ck)
SELECT seq, user_id, b.u AS url, b.v AS value FROM r""")
def maxby_user_running(spark, sf_dir):
    """A4 running: keyBy(user).maxBy(field)."""
    c = clicks(spark, sf_dir)
    return A.max_by_record_running(c, block=_seq_block(c))


@register("user_frequency", f"WITH {CK} SELECT user_id, count(*) AS cnt FROM ck GROUP BY user_id")
def user_frequency(spark, sf_dir):
    """P2 + A5: map to (user, 1), reduce by summing."""
    return A.sum_by_key(P.with_one(clicks(spark, sf_dir), "user_id"), "user_id", "one", "cnt")


@register("user_frequency_running", f"""WITH {CK}
SELECT seq, user_id, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS cnt FROM ck""")
def user_frequency_running(spark, sf_dir):
    """A5 running: the reduce's per-record output."""
    c = clicks(spark, sf_dir)
    return A.count_by_key_running(c, "user_id", "cnt", _seq_block(c))


@register("running_sum_nulls", f"""WITH {CK}
SELECT seq, url, CAST(sum(CASE WHEN url <> 'click' THEN user_id END) OVER (ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM ck""")
def running_sum_nulls(spark, sf_dir):
    """A2 with nulls: running sum of the user id over all clicks, null for
    urls named click; a null adds nothing."""
    c = clicks(spark, sf_dir).select("seq", "url", "user_id")
    value = F.when(F.col("url") != "click", F.col("user_id"))
    return prefix_scan(c, [], ["seq"], _seq_block(c), {"total": ("sum", value)}).select("seq", "url", "total")


@register("most_active_user", f"""WITH {CK}, c AS (
SELECT user_id, count(*) AS c, max(seq) AS q FROM ck GROUP BY user_id)
SELECT user_id, c AS cnt FROM c ORDER BY c DESC, q DESC LIMIT 1""")
def most_active_user(spark, sf_dir):
    """Most active user (the newer one wins an equal count)."""
    return A.most_active(clicks(spark, sf_dir), "user_id", "cnt")


@register("most_active_user_running", f"""WITH {CK}, r AS (
SELECT seq, user_id, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS c FROM ck),
m AS (SELECT seq, max({{'c': c, 'q': seq, 'u': user_id}}) OVER (ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b FROM r)
SELECT seq, b.u AS user_id, b.c AS cnt FROM m""")
def most_active_user_running(spark, sf_dir):
    """A6 running: global reduce over the running per-user counts."""
    c = clicks(spark, sf_dir)
    return A.most_active_running(c, "user_id", "cnt", _seq_block(c))


@register("sql_count_by_user", f"WITH {CK} SELECT user_id, count(url) AS url_count FROM ck GROUP BY user_id")
def sql_count_by_user(spark, sf_dir):
    """A7 + G5: SQL COUNT(url) GROUP BY user over a temporary view."""
    register_view(clicks(spark, sf_dir), "EventTable")
    return spark.sql("SELECT user_id, COUNT(url) AS url_count FROM EventTable GROUP BY user_id")


# ---------------------------------------------------------------- windows

_PV_UV_SQL = f"""WITH {CK}
SELECT (ms // {TUMBLE_MS}) * {TUMBLE_MS} AS window_start, count(*) AS pv, count(DISTINCT user_id) AS uv,
       count(*)::DOUBLE / count(DISTINCT user_id) AS ratio FROM ck GROUP BY 1"""


@register("pv_uv_tumbling", _PV_UV_SQL)
def pv_uv_tumbling(spark, sf_dir):
    """W1 + A9 + A10: page views, unique visitors and their ratio per window."""
    return W.pv_uv(clicks(spark, sf_dir), TUMBLE_MS)


@register("udaf_pv_uv", _PV_UV_SQL)
def udaf_pv_uv(spark, sf_dir):
    """PV/UV of raw clicks as a user-defined aggregate whose accumulator
    holds a set of users; partial accumulators are merged in a keyed step."""
    ms = F.col("ms") - F.pmod(F.col("ms"), F.lit(TUMBLE_MS))
    c = clicks(spark, sf_dir).select(ms.alias("window_start"), "user_id")
    return aggregate_with(c, ["window_start"], PvUv(), "window_start long, pv long, uv long, ratio double")


@register("url_count_tumbling", f"""WITH {CK}
SELECT url, count(*) AS cnt, (ms // {TUMBLE_MS}) * {TUMBLE_MS} AS window_start,
       (ms // {TUMBLE_MS}) * {TUMBLE_MS} + {TUMBLE_MS} AS window_end FROM ck GROUP BY url, 3, 4""")
def url_count_tumbling(spark, sf_dir):
    """W2 + A8 + A11: clicks per url per tumbling window."""
    return W.url_counts(clicks(spark, sf_dir), TUMBLE_MS)


def _sliding_starts_sql(size: int, step: int) -> str:
    """Every (url, window start) a click falls in: one shifted copy of the
    clicks per window overlap (UNION ALL, no join)."""
    return "\nUNION ALL ".join(f"SELECT url, (ms // {step}) * {step} - {k * step} AS ws FROM ck"
                               for k in range(size // step))


_SLIDING_SQL = f"""WITH {CK}, s AS (
{_sliding_starts_sql(SLIDE_SIZE_MS, SLIDE_STEP_MS)}),
c AS (SELECT url, count(*) AS cnt, ws AS window_start, ws + {SLIDE_SIZE_MS} AS window_end FROM s GROUP BY url, ws)"""


@register("url_count_sliding", f"{_SLIDING_SQL} SELECT * FROM c")
def url_count_sliding(spark, sf_dir):
    """W3 + W4: clicks per url per sliding window."""
    return W.url_counts(clicks(spark, sf_dir), SLIDE_SIZE_MS, SLIDE_STEP_MS)


_TOPN_SQL = f"""{_SLIDING_SQL}, r AS (
SELECT window_end, url, cnt, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS INTEGER) AS rk
FROM c) """


@register("topn_sliding", f"{_TOPN_SQL} SELECT window_end, url, cnt, rk FROM r WHERE rk <= {TOP_N}")
def topn_sliding(spark, sf_dir):
    """T1 + T2 + G4: top-N urls per sliding window."""
    counts = W.url_counts(clicks(spark, sf_dir), SLIDE_SIZE_MS, SLIDE_STEP_MS)
    return top_n(counts, TOP_N).select("window_end", "url", "cnt", "rk")


@register("topn_report", f"""{_TOPN_SQL}
SELECT window_end, string_agg('No.' || rk || ' url:' || url || ' 访问量:' || cnt || chr(10), '' ORDER BY rk)
       || '----------------------' AS report
FROM r WHERE rk <= {TOP_N} GROUP BY window_end""")
def topn_report(spark, sf_dir):
    """The ranking rendered as the reference's text block."""
    return report(topn_sliding(spark, sf_dir))


# ----------------------------------------- the reference's own window sizes

REF_PV_UV_MS = 5_000           # PV/UV window of the reference
REF_URL_WINDOW_MS = 10_000     # url-count window of the reference
REF_SLIDE = (10_000, 5_000)    # top-N window size and slide of the reference


def _pv_uv_sql(size: int) -> str:
    return f"""WITH {CK}
SELECT (ms // {size}) * {size} AS window_start, count(*) AS pv, count(DISTINCT user_id) AS uv,
       count(*)::DOUBLE / count(DISTINCT user_id) AS ratio FROM ck GROUP BY 1"""


def _url_tumbling_sql(size: int) -> str:
    text = ("'UrlPojo{url=''' || url || ''', count=' || CAST(cnt AS VARCHAR) || ', windowStart=' || "
            f"{sql_ts_text('window_start')} || ', windowEnd=' || {sql_ts_text('window_end')} || '}}'")
    return f"""WITH {CK}, w AS (
SELECT url, count(*) AS cnt, (ms // {size}) * {size} AS window_start,
       (ms // {size}) * {size} + {size} AS window_end FROM ck GROUP BY url, 3, 4)
SELECT *, {text} AS text FROM w"""


def _topn_sql(size: int, step: int, n: int) -> str:
    return f"""WITH {CK}, s AS (
{_sliding_starts_sql(size, step)}),
c AS (SELECT url, count(*) AS cnt, ws + {size} AS window_end FROM s GROUP BY url, ws),
r AS (SELECT window_end, url, cnt,
      CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS INTEGER) AS rk FROM c)
SELECT window_end, url, cnt, rk FROM r WHERE rk <= {n}"""


@register("pv_uv_tumbling_5s", _pv_uv_sql(REF_PV_UV_MS))
def pv_uv_tumbling_5s(spark, sf_dir):
    """W1 + A9 at the reference's 5 s window."""
    return W.pv_uv(clicks(spark, sf_dir), REF_PV_UV_MS)


@register("url_count_tumbling_10s", _url_tumbling_sql(REF_URL_WINDOW_MS))
def url_count_tumbling_10s(spark, sf_dir):
    """W2 + A11 + C9 at the reference's 10 s window, with the record's text."""
    return W.url_counts(clicks(spark, sf_dir), REF_URL_WINDOW_MS).withColumn("text", W.window_count_text())


@register("topn_sliding_10s", _topn_sql(*REF_SLIDE, TOP_N))
def topn_sliding_10s(spark, sf_dir):
    """T2 at the reference's 10 s / 5 s sliding window, top 2."""
    counts = W.url_counts(clicks(spark, sf_dir), *REF_SLIDE)
    return top_n(counts, TOP_N).select("window_end", "url", "cnt", "rk")


# ------------------------------------------------------ two inputs, timers

@register("co_map_union", """
SELECT 'int:' || CAST(n_nationkey AS VARCHAR) AS v FROM nation
UNION ALL SELECT 'Long:' || CAST(c_custkey AS VARCHAR) AS v FROM customer""")
def co_map_union(spark, sf_dir):
    """Connect an int stream and a long stream, map both to strings."""
    return _co_map(table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer"),
                   "n_nationkey", "c_custkey")


_JOIN_SQL = f"""WITH {CK}, f AS (SELECT user_id, min(ms) AS first_ms FROM ck GROUP BY user_id)
SELECT c.user_id, c.seq, c.ms AS left_ms, f.first_ms AS right_ms,
  CAST(c.user_id AS VARCHAR) || ' ' || CAST(c.ms AS VARCHAR) || '=>(' || CAST(c.user_id AS VARCHAR) || ','
  || CAST(f.first_ms AS VARCHAR) || ')' AS text
FROM ck c JOIN f ON c.user_id = f.user_id"""


def first_seen(c: DataFrame) -> DataFrame:
    """One row per user: the time of the user's first click (a keyed stream
    whose key is unique, so the join below emits one row per click)."""
    return c.groupBy("user_id").agg(F.min("ms").alias("right_ms"))


@register("keyed_join", _JOIN_SQL)
def keyed_join(spark, sf_dir):
    """Keyed inner join of the click stream with the users' first-seen
    stream over full history; hot users are salted."""
    c = clicks(spark, sf_dir)
    left = c.select("user_id", "seq", F.col("ms").alias("left_ms"))
    j = _join(left, first_seen(c), "user_id", salt_of=F.xxhash64("seq"), buckets=8, fraction=0.05)
    return j.select("user_id", "seq", "left_ms", "right_ms",
                    join_text(F.col("user_id"), F.col("left_ms"), F.col("right_ms")).alias("text"))


@register("changelog_count", f"""WITH {CK}, r AS (
SELECT seq, url, row_number() OVER (PARTITION BY url ORDER BY seq) AS n FROM ck)
SELECT seq, 0 AS pos, '-U' AS op, url, n - 1 AS n FROM r WHERE n > 1
UNION ALL
SELECT seq, CASE WHEN n > 1 THEN 1 ELSE 0 END AS pos, CASE WHEN n = 1 THEN '+I' ELSE '+U' END AS op, url, n FROM r""")
def changelog_count(spark, sf_dir):
    """K8: changelog (+I/-U/+U) of an updating COUNT per url."""
    c = clicks(spark, sf_dir)
    return _changelog(c, "url", _seq_block(c))


@register("timer_per_event", f"""WITH {CK}, e AS (SELECT max(ms) AS m FROM ck),
u AS (SELECT user_id, 'data' AS kind, ms AS at_ms FROM ck
  UNION ALL SELECT DISTINCT user_id, 'timer' AS kind, ms + {TIMER_DELAY_MS} AS at_ms FROM ck
  WHERE ms + {TIMER_DELAY_MS} <= (SELECT m FROM e))
SELECT user_id, kind, at_ms, CAST(user_id AS VARCHAR) || CASE WHEN kind = 'data' THEN ',数据时间戳:'
  ELSE ',定时器触发时间:' END || {sql_ts_text('at_ms')} AS msg FROM u""")
def timer_per_event(spark, sf_dir):
    """E5 + E11: per-element event-time timer at ts + 10 s."""
    return _timers(clicks(spark, sf_dir), TIMER_DELAY_MS, "user_id")


@register("periodic_user_pv", f"""WITH {CK}, f AS (SELECT user_id, min(ms) AS first_ms FROM ck GROUP BY user_id),
e AS (SELECT max(ms) AS m FROM ck),
t AS (SELECT user_id, unnest(range(first_ms + {REPORT_PERIOD_MS}, (SELECT m FROM e) + 1, {REPORT_PERIOD_MS})) AS tick FROM f),
ev AS (SELECT user_id, ms AS t_ms, 0 AS is_tick FROM ck UNION ALL SELECT user_id, tick AS t_ms, 1 AS is_tick FROM t),
r AS (SELECT user_id, t_ms, is_tick, sum(1 - is_tick) OVER (PARTITION BY user_id ORDER BY t_ms, is_tick
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv FROM ev)
SELECT user_id, t_ms AS tick, CAST(pv AS BIGINT) AS pv, CAST(user_id AS VARCHAR) || ',pv:' || CAST(pv AS VARCHAR) AS msg
FROM r WHERE is_tick = 1""")
def periodic_user_pv(spark, sf_dir):
    """E8 + E10: cumulative PV per user reported every period."""
    return periodic_counts(clicks(spark, sf_dir), REPORT_PERIOD_MS, "user_id").withColumn(
        "msg", pv_report_text("user_id"))


@register("rich_map_length", f"WITH {CK} SELECT seq, CAST(length(url) AS INTEGER) AS len FROM ck")
def rich_map_length(spark, sf_dir):
    """Rich map with per-task open/close (mapInPandas)."""
    return map_rich(clicks(spark, sf_dir).select("seq", "url"), lambda: LengthMapper("url", "len"),
                    "seq long, len int")


@register("scalar_battery", f"""WITH {CK}
SELECT seq, url AS trimmed, strftime(ts, '%Y-%m-%d %H:%M:%S') AS day_text, {sql_ts_text('ms')} AS ts_text,
  value / (user_id + 1) AS ratio,
  coalesce(CASE WHEN url = 'click' THEN NULL ELSE user_id END + 1, 1) AS dflt FROM ck""")
def scalar_battery(spark, sf_dir):
    """C2, C8, C9, C12, C14 on the click view."""
    c = clicks(spark, sf_dir)
    padded = F.concat(F.lit("\t"), F.col("url"), F.lit(" \n"))
    maybe = F.when(F.col("url") == "click", F.lit(None).cast(T.LongType())).otherwise(F.col("user_id"))
    return c.select("seq", java_trim(padded).alias("trimmed"), datetime_text(F.col("ms")).alias("day_text"),
                    sql_timestamp_text(F.col("ms")).alias("ts_text"),
                    (F.col("value") / (F.col("user_id") + 1)).cast("double").alias("ratio"),
                    F.coalesce(maybe + 1, F.lit(1).cast("long")).alias("dflt"))
