"""Keyed aggregations (A1-A7) in two forms each.

*final*   -- one row per key, ``groupBy().agg()``: partial aggregation on the
             map side, so a hot key costs one row per map task in the shuffle.
*running* -- one row per input row carrying the aggregate so far, which is
             what a streaming ``keyBy().sum/max/maxBy/reduce`` prints.  Built on
             ``scan.prefix_scan`` so a hot key is split into bounded blocks.

Arrival order is the ``seq`` column; ties are broken by it explicitly
(``max_by`` alone is not deterministic on ties).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.operators.scan import DEFAULT_BLOCK, block_of, prefix_scan, running_best


def _blk(block: Column | None, order: str = "seq") -> Column:
    return block if block is not None else block_of(order, DEFAULT_BLOCK)


# -- A1 / A2: sum --------------------------------------------------------

def sum_by_key(df: DataFrame, key: str, value: str, out: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(out))


def running_sum(df: DataFrame, key: str, order: list[str], value: Column, out: str,
                block: Column) -> DataFrame:
    return prefix_scan(df, [key], order, block, {out: ("sum", value)})


# -- A3: max of one field, other fields from the key's first record -----

def max_keep_first(clicks: DataFrame, key: str = "user_id", field: str = "value",
                   keep: str = "url") -> DataFrame:
    return clicks.groupBy(key).agg(F.min_by(keep, "seq").alias(keep), F.max(field).alias(field))


def max_keep_first_running(clicks: DataFrame, key: str = "user_id", field: str = "value",
                           keep: str = "url", block: Column | None = None) -> DataFrame:
    base = clicks.select("seq", key, F.col(keep).alias("_k"), F.col(field).alias("_v"))
    r = prefix_scan(base, [key], ["seq"], _blk(block),
                    {keep: ("first", F.col("_k")), field: ("max", F.col("_v"))})
    return r.select("seq", key, keep, field)


# -- A4: maxBy -- the whole record holding the max, first one on a tie ----

def _maxby_struct(field: str, keep: str) -> Column:
    # ordering: larger field wins, then smaller seq (earlier record) wins
    return F.struct(F.col(field).alias("v"), (-F.col("seq")).alias("neg_seq"),
                    F.col("seq").alias("seq"), F.col(keep).alias("k"))


def max_by_record(clicks: DataFrame, key: str = "user_id", field: str = "value",
                  keep: str = "url") -> DataFrame:
    best = F.max(_maxby_struct(field, keep)).alias("_best")
    return clicks.groupBy(key).agg(best).select(
        key, F.col("_best.seq").alias("seq"), F.col("_best.k").alias(keep), F.col("_best.v").alias(field))


def max_by_record_running(clicks: DataFrame, key: str = "user_id", field: str = "value",
                          keep: str = "url", block: Column | None = None) -> DataFrame:
    base = clicks.select("seq", key, _maxby_struct(field, keep).alias("_s"))
    r = prefix_scan(base, [key], ["seq"], _blk(block), {"_best": ("max", F.col("_s"))})
    return r.select("seq", key, F.col("_best.k").alias(keep), F.col("_best.v").alias(field))


# -- A5: count per key (reduce of (key, 1L)) --------------------------------

def count_by_key(clicks: DataFrame, key: str = "user_id", out: str = "cnt") -> DataFrame:
    return clicks.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def count_by_key_running(clicks: DataFrame, key: str = "user_id", out: str = "cnt",
                         block: Column | None = None) -> DataFrame:
    base = clicks.select("seq", key)
    return prefix_scan(base, [key], ["seq"], _blk(block), {out: ("sum", F.lit(1).cast("long"))})


# -- A6: most active key (global arg-max of the running counts) ------------

def most_active(clicks: DataFrame, key: str = "user_id", out: str = "cnt") -> DataFrame:
    """On equal counts the newer record wins in the reference's reduce, so the
    winner among tied keys is the one whose last click is latest."""
    per_key = clicks.groupBy(key).agg(F.count(F.lit(1)).alias("c"), F.max("seq").alias("q"))
    best = per_key.agg(F.max(F.struct("c", "q", key)).alias("_b"))
    return best.select(F.col(f"_b.{key}").alias(key), F.col("_b.c").alias(out))


def most_active_running(clicks: DataFrame, key: str = "user_id", out: str = "cnt",
                        block: Column | None = None) -> DataFrame:
    return running_best(clicks.select("seq", key), key, _blk(block), "seq", out)


# -- A7 / K5 ------------------------------------------------------------------

def latest_per_key(clicks: DataFrame, key: str = "user_id", value: str = "url") -> DataFrame:
    """Keyed upsert result: the value of each key's newest record (by event
    time, then arrival)."""
    return clicks.groupBy(key).agg(F.max_by(value, F.struct("ms", "seq")).alias(value))
