"""Record types of the click model.

A click is ``(user, url, timestamp)`` with ``timestamp`` in epoch
milliseconds.  Because arrival order carries meaning for running aggregates,
every click also carries ``seq``: its position in the input.
"""

from __future__ import annotations

from pyspark.sql import types as T

CLICK = T.StructType([
    T.StructField("seq", T.IntegerType()),
    T.StructField("user", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

WINDOW_COUNT = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("windowStart", T.LongType()),
    T.StructField("windowEnd", T.LongType()),
])

KEYED_EVENT = T.StructType([
    T.StructField("seq", T.IntegerType()),
    T.StructField("key", T.StringType()),
    T.StructField("src", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

LINE = T.StructType([T.StructField("value", T.StringType())])

# Click view of the driver's ``events`` table (see sources.tables.clicks).
CLICK_VIEW_COLUMNS = ("seq", "user_id", "url", "ts", "ms", "value")

HOUR_MS = 3_600_000
DAY_MS = 86_400_000
