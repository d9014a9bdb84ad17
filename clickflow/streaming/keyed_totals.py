"""Changelog of a COUNT per key over micro-batches, without keyed state.

Used where a keyed streaming result needs "count so far" per record and the
key set is small or skewed (five urls, one of them possibly holding a third
of the rows).  Keyed state would send each key's rows of a micro-batch to one
task; instead each micro-batch is a batch job: in-batch running counts come
from the blocked prefix scan (skew-safe), each key's count before the batch
from a log of counts per key (``keyed_log``), which lies under
``spark.checkpoint.dir`` next to the query's checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators.changelog import changes_from_counts
from clickflow.operators.scan import adaptive_block, prefix_scan
from clickflow.streaming.keyed_log import KeyedLog


class KeyedTotals(KeyedLog):
    """Records per key so far."""

    def __init__(self, spark: SparkSession, key: str, name: str, key_type: str = "string",
                 path: str | None = None, every: int = 10):
        super().__init__(spark, name, f"{key} {key_type}, total long", [key], {"total": "sum"}, path, every)
        self.key = key


def changelog_batch(batch: DataFrame, batch_id: int, totals: KeyedTotals) -> DataFrame:
    """One micro-batch of a COUNT changelog: +I / -U / +U rows for its records."""
    key = totals.key
    prev = totals.before(batch_id)
    counted = prefix_scan(batch.select("seq", key), [key], ["seq"], adaptive_block(batch, "seq"),
                          {"n_local": ("sum", F.lit(1).cast("long"))})
    # one row per key on the right: broadcast by AQE when small, else a
    # sort-merge join whose skewed partitions AQE splits; null-safe, so a
    # null key keeps its own running total
    base = prev.select(F.col(key).alias("_pk"), F.col("total").alias("_base"))
    with_base = counted.join(base, F.col(key).eqNullSafe(F.col("_pk")), "left")
    n = F.coalesce(F.col("_base"), F.lit(0)) + F.col("n_local")
    changes = changes_from_counts(with_base.select("seq", key, n.alias("n")), key)
    totals.write(batch_id, batch.groupBy(key).agg(F.count(F.lit(1)).alias("total")))
    return changes
