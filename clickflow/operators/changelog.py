"""Changelog of an updating count (K8), batch form.

``toChangelogStream`` of ``SELECT k, COUNT(*) GROUP BY k`` emits ``+I`` for a
key's first row, then ``-U`` (old count) and ``+U`` (new count) per later row.
The running count comes from the blocked prefix scan, then each row expands
to one or two change rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.operators.scan import DEFAULT_BLOCK, block_of, prefix_scan

# Row kinds of a changelog.
INSERT, UPDATE_BEFORE, UPDATE_AFTER = "+I", "-U", "+U"


def changes_from_counts(counted: DataFrame, key: str, n: str = "n") -> DataFrame:
    nc = F.col(n)
    before = F.struct(F.lit(UPDATE_BEFORE).alias("op"), (nc - 1).alias("n"))
    after = F.struct(F.when(nc == 1, F.lit(INSERT)).otherwise(F.lit(UPDATE_AFTER)).alias("op"), nc.alias("n"))
    rows = F.when(nc > 1, F.array(before, after)).otherwise(F.array(after))
    return counted.select("seq", key, F.posexplode(rows).alias("pos", "_c")).select(
        "seq", "pos", F.col("_c.op").alias("op"), key, F.col("_c.n").alias("n"))


def changelog_count(clicks: DataFrame, key: str = "url", block: Column | None = None) -> DataFrame:
    blk = block if block is not None else block_of("seq", DEFAULT_BLOCK)
    counted = prefix_scan(clicks.select("seq", key), [key], ["seq"], blk,
                          {"n": ("sum", F.lit(1).cast("long"))})
    return changes_from_counts(counted, key)
