"""Top-N per window.

``row_number() <= n`` lets Spark insert a *partial* ``WindowGroupLimit`` before
the shuffle, so each map task forwards at most n rows per window: a window
with millions of urls never arrives whole at one task.  Ties on the count go
to the smaller url (arrival order is not reproducible across engines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The ranking report text of the reference.
REPORT_LINE = "No.%d url:%s 访问量:%d\n"
REPORT_RULE = "----------------------"


def top_n(counts: DataFrame, n: int, part: str = "window_end", count: str = "cnt",
          item: str = "url") -> DataFrame:
    w = Window.partitionBy(part).orderBy(F.col(count).desc(), F.col(item).asc())
    return counts.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= n)


def report(ranked: DataFrame, part: str = "window_end", count: str = "cnt",
           item: str = "url") -> DataFrame:
    """Render each window's ranking as the reference's text block.  The list
    gathered per window holds at most n rows (it follows ``top_n``)."""
    entries = F.sort_array(F.collect_list(F.struct("rk", F.col(item).alias("u"), F.col(count).alias("c"))))
    lines = F.transform(entries, lambda e: F.format_string(
        REPORT_LINE, e["rk"], e["u"], e["c"]))
    text = F.concat(F.array_join(lines, ""), F.lit(REPORT_RULE))
    return ranked.groupBy(part).agg(text.alias("report"))
