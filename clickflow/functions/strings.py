"""String expressions with the reference's (JVM string) semantics."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_split(col: Column, sep: str) -> Column:
    """Split on a literal separator the way ``String.split(sep)`` does.

    Inner and leading empty tokens are kept, trailing empty tokens dropped; an
    empty string gives one empty token; a string made only of separators gives
    no tokens.  Spark's ``split`` keeps trailing empties, so they are stripped
    from the input first.
    """
    esc = re.escape(sep)
    if len(sep) == 1:
        stripped = F.rtrim(col, F.lit(sep))   # no regex for a one-char separator
    else:
        stripped = F.regexp_replace(col, f"(?:{esc})+\\z", "")
    empty = F.array().cast("array<string>")
    return (F.when(col.isNull(), F.lit(None).cast("array<string>"))
            .when((F.length(col) > 0) & (F.length(stripped) == 0), empty)
            .otherwise(F.split(stripped, esc)))


def java_trim(col: Column) -> Column:
    """``String.trim``: strips every char <= U+0020 at both ends (Spark's
    ``trim`` strips spaces only).  ``\\z`` is the very end; ``$`` would also match
    before a final line break."""
    return F.regexp_replace(col, r"^[\x00-\x20]+|[\x00-\x20]+\z", "")


# The click record's display format, Event{user='u', url='x', timestamp=t}
EVENT_PREFIX, EVENT_URL, EVENT_TS, EVENT_SUFFIX = "Event{user='", "', url='", "', timestamp=", "}"


def event_string(user: Column, url: Column, ts_text: Column) -> Column:
    """Display form of a click record."""
    return F.concat(F.lit(EVENT_PREFIX), user.cast("string"), F.lit(EVENT_URL),
                    url, F.lit(EVENT_TS), ts_text.cast("string"), F.lit(EVENT_SUFFIX))


def json_object(key: Column, value: Column) -> Column:
    """One-entry JSON document ``{"key":"value"}`` (the document-index record)."""
    return F.to_json(F.create_map(key.cast("string"), value.cast("string")))
