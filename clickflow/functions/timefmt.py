"""Event-time expressions.  Times travel as epoch-millisecond BIGINTs; a
TIMESTAMP column is derived only where Spark needs one (windows, watermarks).
Rendering assumes the session zone is UTC (``session.use_utc``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def datetime_text(ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` (SimpleDateFormat display used by click records)."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")


def sql_timestamp_text(ms: Column) -> Column:
    """``java.sql.Timestamp.toString`` of epoch ms: seconds, a dot, then the
    millisecond fraction without trailing zeros (``.0`` when it is zero)."""
    frac = F.pmod(ms, F.lit(1000))
    frac_txt = F.when(frac == 0, F.lit("0")).otherwise(
        F.regexp_replace(F.lpad(frac.cast("string"), 3, "0"), "0+$", ""))
    return F.concat(datetime_text(ms), F.lit("."), frac_txt)


def window_bounds_ms(window: Column) -> tuple[Column, Column]:
    """(start, end) of a ``window`` struct as epoch ms."""
    return F.unix_millis(window.start), F.unix_millis(window.end)
