"""Event-time windows (W1-W4) and windowed aggregates.

The same functions serve batch and streaming DataFrames: ``window()`` on the
event-time TIMESTAMP column, bounds emitted as epoch-ms BIGINT like the
reference's window records.  Distinct visitors use two chained aggregations
((window, user) then window): exact, no per-window set in memory, partial
aggregation at both levels, and accepted by Structured Streaming, which
rejects ``count(DISTINCT)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.functions.timefmt import sql_timestamp_text


def event_window(size_ms: int, slide_ms: int | None = None, ts: str = "ts") -> Column:
    size = f"{int(size_ms)} milliseconds"
    if slide_ms and slide_ms != size_ms:
        return F.window(ts, size, f"{int(slide_ms)} milliseconds")
    return F.window(ts, size)


def _bounds(prefix: str = "window") -> list[Column]:
    return [F.unix_millis(F.col(f"{prefix}.start")).alias("window_start"),
            F.unix_millis(F.col(f"{prefix}.end")).alias("window_end")]


# The window-count record's display format,
# UrlPojo{url='u', count=n, windowStart=<timestamp>, windowEnd=<timestamp>}
COUNT_PREFIX, COUNT_N, COUNT_START, COUNT_END, COUNT_SUFFIX = (
    "UrlPojo{url='", "', count=", ", windowStart=", ", windowEnd=", "}")


def window_count_text(url: str = "url", count: str = "cnt") -> Column:
    """Display form of a window count; bounds rendered like java.sql.Timestamp."""
    return F.concat(F.lit(COUNT_PREFIX), F.col(url), F.lit(COUNT_N), F.col(count).cast("string"),
                    F.lit(COUNT_START), sql_timestamp_text(F.col("window_start")),
                    F.lit(COUNT_END), sql_timestamp_text(F.col("window_end")), F.lit(COUNT_SUFFIX))


def url_counts(clicks: DataFrame, size_ms: int, slide_ms: int | None = None,
               key: str = "url") -> DataFrame:
    """A8 + A11: count per (window, key) with the window bounds attached."""
    g = clicks.groupBy(event_window(size_ms, slide_ms).alias("window"), key)
    return g.agg(F.count(F.lit(1)).alias("cnt")).select(key, "cnt", *_bounds())


def visits_per_user(clicks: DataFrame, size_ms: int, slide_ms: int | None = None,
                    user: str = "user_id") -> DataFrame:
    """First level of PV/UV: clicks per (window, user)."""
    return clicks.groupBy(event_window(size_ms, slide_ms).alias("window"), user).agg(
        F.count(F.lit(1)).alias("clicks"))


def pv_uv_from_visits(visits: DataFrame) -> DataFrame:
    """Second level: page views, unique visitors and PV/UV per window."""
    g = visits.groupBy("window").agg(F.sum("clicks").alias("pv"), F.count(F.lit(1)).alias("uv"))
    return g.select(F.unix_millis(F.col("window.start")).alias("window_start"), "pv", "uv",
                    (F.col("pv").cast("double") / F.col("uv")).alias("ratio"))


def pv_uv(clicks: DataFrame, size_ms: int, slide_ms: int | None = None,
          user: str = "user_id") -> DataFrame:
    """A9 + A10 + W1."""
    return pv_uv_from_visits(visits_per_user(clicks, size_ms, slide_ms, user))


def split_late(rows: DataFrame, watermark_ms: int, size_ms: int) -> tuple[DataFrame, DataFrame]:
    """(on time, late): a row is late when its tumbling window had closed under the
    watermark before the row was processed.  Each row is in exactly one of them."""
    end = (F.floor(F.col("ms") / size_ms) + 1) * size_ms
    late = F.coalesce(end <= F.lit(watermark_ms), F.lit(False))
    return rows.where(~late), rows.where(late)
