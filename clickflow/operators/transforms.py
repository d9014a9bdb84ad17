"""Stateless row operators: map, flatMap, filter, process.

All are column expressions over the click view (``seq, user_id, url, ms``)
so they run inside whole-stage codegen, batch or streaming alike.  flatMap
becomes ``posexplode`` of an array built per row; ``pos`` keeps the emit
order a collector would give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.functions.strings import event_string, java_split, java_trim
from clickflow.functions.timefmt import datetime_text


def map_field(clicks: DataFrame, field: str = "user_id") -> DataFrame:
    """Keep one field per record."""
    return clicks.select("seq", field)


def with_one(clicks: DataFrame, key: str = "user_id") -> DataFrame:
    """Record -> (key, 1L)."""
    return clicks.select("seq", key, F.lit(1).cast("long").alias("one"))


def field_length(clicks: DataFrame, field: str = "url", out: str = "len") -> DataFrame:
    """String length of a field (code points)."""
    return clicks.select("seq", F.length(F.col(field).cast("string")).alias(out))


def event_text() -> Column:
    """P3 raw form: ``Event{user='…', url='…', timestamp=<ms>}``."""
    return event_string(F.col("user_id"), F.col("url"), F.col("ms"))


def event_display_text() -> Column:
    """P3 display form with ``yyyy-MM-dd HH:mm:ss`` time."""
    return event_string(F.col("user_id"), F.col("url"), datetime_text(F.col("ms")))


def event_strings(clicks: DataFrame) -> DataFrame:
    return clicks.select("seq", event_text().alias("event"), event_display_text().alias("display"))


def filter_equals(clicks: DataFrame, field: str, value) -> DataFrame:
    """equality filter (a literal predicate, pushed into the parquet scan)."""
    return clicks.filter(F.col(field) == F.lit(value))


def flatmap_fields(clicks: DataFrame) -> DataFrame:
    """Each record emits its user, then its timestamp, as strings."""
    arr = F.array(F.col("user_id").cast("string"), F.col("ms").cast("string"))
    return clicks.select("seq", F.posexplode(arr).alias("pos", "v"))


def flatmap_conditional(clicks: DataFrame, user_value) -> DataFrame:
    """For the chosen user emit url and timestamp first; then user and
    timestamp for every record."""
    u, url, ts = F.col("user_id").cast("string"), F.col("url"), F.col("ms").cast("string")
    arr = F.when(F.col("user_id") == F.lit(user_value), F.array(url, ts, u, ts)).otherwise(F.array(u, ts))
    return clicks.select("seq", F.posexplode(arr).alias("pos", "v"))


def process_conditional(clicks: DataFrame, user_value) -> DataFrame:
    """P10: for the chosen user emit ``<user>clicks<url>``; then the record's
    text for every record."""
    u = F.col("user_id").cast("string")
    extra = F.concat(u, F.lit("clicks"), F.col("url"))
    arr = F.when(F.col("user_id") == F.lit(user_value), F.array(extra, event_text())).otherwise(F.array(event_text()))
    return clicks.select("seq", F.posexplode(arr).alias("pos", "v"))


def click_csv_lines(clicks: DataFrame) -> DataFrame:
    """Clicks rendered as the reference's wire lines ``user,url, ms``."""
    line = F.concat(F.col("user_id").cast("string"), F.lit(","), F.col("url"), F.lit(", "),
                    F.col("ms").cast("string"))
    return clicks.select("seq", line.alias("value"))


def parse_click_csv(lines: DataFrame, value: str = "value", strict: bool = True,
                    keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """P5: ``"mary,./a, 1000"`` -> (user, url, timestamp).

    Split on ``,`` with string-split semantics, trim each field, parse the
    third as a long; extra fields are ignored.  ``strict`` fails the job on a
    malformed line (as the reference's map does); otherwise malformed lines
    get ``timestamp`` null and ``_bad`` true, see ``split_rejects``.
    """
    # split once; the fields below share it
    lines = lines.select(*keep, value, java_split(F.col(value), ",").alias("_parts"))
    parts = F.col("_parts")
    f = [java_trim(F.element_at(parts, i)) for i in (1, 2, 3)]
    n = F.size(parts)
    ts = f[2].try_cast("long")
    bad = (n < 3) | ts.isNull()
    cols = [*keep, F.when(n >= 1, f[0]).alias("user"), F.when(n >= 2, f[1]).alias("url")]
    if strict:
        # a generator of one row: no column pruning (not even count()) skips the check, and unlike
        # a filter it is not pushed below the split, which would then run twice
        err = F.raise_error(F.concat(F.lit("malformed click line: "), F.col(value)))
        rec = F.array(F.struct(*cols[len(keep):], ts.alias("timestamp")))
        return lines.select(*keep, F.inline(F.when(F.coalesce(bad, F.lit(True)), err).otherwise(rec)))
    return lines.select(*cols, ts.alias("timestamp"), bad.alias("_bad"))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tolerant parse -> (good rows, rejected rows)."""
    return parsed.filter(~F.col("_bad")).drop("_bad"), parsed.filter(F.col("_bad")).drop("_bad")


def words(lines: DataFrame, col: str = "value", keep: tuple[str, ...] = (), positions: bool = True) -> DataFrame:
    """P7 tokenizer: split each line on a single space (string-split
    semantics), one row per token, with its 0-based position if asked."""
    toks = java_split(F.col(col), " ")
    if positions:
        return lines.select(*keep, F.posexplode(toks).alias("pos", "word"))
    return lines.select(*keep, F.explode(toks).alias("word"))
