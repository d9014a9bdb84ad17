"""Two-input operators: connect+map union (U1) and keyed inner join.

The join is a plain equi-join, so Catalyst picks broadcast-hash (small side
under ``autoBroadcastJoinThreshold``, a size it measures) or sort-merge, and
AQE splits skewed partitions at run time.  ``salted_join`` adds an explicit
guard for keys found to be hot: only those keys are spread over sub-keys on
the big side (one per ``rows_per_bucket`` of their rows, at least ``buckets``)
and replicated on the other, so a key with a third of the rows is processed by
many tasks instead of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def co_map_union(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
                 left_prefix: str = "int:", right_prefix: str = "Long:") -> DataFrame:
    """Map each input to one string type and take the bag union (no matching)."""
    a = left.select(F.concat(F.lit(left_prefix), F.col(left_col).cast("string")).alias("v"))
    b = right.select(F.concat(F.lit(right_prefix), F.col(right_col).cast("string")).alias("v"))
    return a.unionByName(b)


def hot_keys(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Keys holding more than ``fraction`` of all rows.  At most 1/fraction
    keys can qualify, which bounds the size of what gets broadcast."""
    if not 0 < fraction < 1:
        raise ValueError("fraction must be in (0, 1)")
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > total * F.lit(fraction)).select(key, "_n")


def salted_join(big: DataFrame, small: DataFrame, key: str, salt_of: Column,
                buckets: int = 16, fraction: float = 0.01, how: str = "inner",
                rows_per_bucket: int = 2_000_000, hot: DataFrame | None = None) -> DataFrame:
    """Equi-join on ``key`` with each hot key of ``big`` split over
    ``max(buckets, rows / rows_per_bucket)`` sub-keys, so the work per task
    stays bounded however large the hot key grows.

    ``salt_of`` is a deterministic per-row expression of ``big`` (e.g. a hash
    of its unique id) so retried tasks salt identically.  Inner and left joins
    only: the small side is replicated per salt, so an unmatched small row
    would repeat in a right or full outer join.  ``hot`` (key, ``_n``) may be
    passed when the caller already counted rows per key.
    """
    if how not in ("inner", "left", "left_outer", "leftouter"):
        raise ValueError(f"salted_join supports inner and left joins, not {how!r}")
    hot_rows = hot if hot is not None else hot_keys(big, key, fraction)
    b, s = salt_inputs(big, small, key, salt_of, hot_rows, buckets, rows_per_bucket)
    return b.join(s, [key, "_salt"], how).drop("_salt")


def keyed_join(left: DataFrame, right: DataFrame, key: str, salt_of: Column | None = None,
               buckets: int = 16, fraction: float = 0.01) -> DataFrame:
    """Inner join over the full history of both inputs."""
    if salt_of is None:
        return left.join(right, key, "inner")
    return salted_join(left, right, key, salt_of, buckets, fraction)


def join_text(key: Column, left_ms: Column, right_ms: Column) -> Column:
    """Pair rendering ``<k> <ts>=>(<k>,<ts>)`` (left row's view)."""
    k = key.cast("string")
    return F.concat(k, F.lit(" "), left_ms.cast("string"), F.lit("=>("), k, F.lit(","),
                    right_ms.cast("string"), F.lit(")"))


def keyed_join_within(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                      bound_ms: int) -> DataFrame:
    """J1 with an optional time bound: pairs whose event times lie within
    ``bound_ms`` of each other.  On streams with watermarks on both inputs,
    Spark evicts join state older than the bound, so state stays bounded
    (the unbounded form keeps all history, as the reference does)."""
    b = F.expr(f"INTERVAL {int(bound_ms)} MILLISECONDS")
    l, r = left.alias("l"), right.alias("r")
    cond = ((F.col(f"l.{key}") == F.col(f"r.{key}"))
            & (F.col(f"r.{right_ts}") >= F.col(f"l.{left_ts}") - b)
            & (F.col(f"r.{right_ts}") <= F.col(f"l.{left_ts}") + b))
    return l.join(r, cond, "inner")


def salt_inputs(big: DataFrame, small: DataFrame, key: str, salt_of: Column, hot: DataFrame,
                buckets: int = 16, rows_per_bucket: int = 2_000_000) -> tuple[DataFrame, DataFrame]:
    """The two inputs of a salted equi-join, for callers that add their own
    join condition (e.g. a stream-stream join with a time bound): both get a
    ``_salt`` column; join on (key, _salt).  ``hot`` (key, ``_n``) is a
    bounded list of hot keys, known in advance (from history for streams);
    joining it to a stream is a stream-static broadcast join."""
    nb = F.greatest(F.lit(buckets), F.ceil(F.col("_n") / F.lit(rows_per_bucket))).cast("long")
    hot_b = F.broadcast(hot.select(key, nb.alias("_nb")))
    b = (big.join(hot_b, key, "left")
         .withColumn("_salt", F.when(F.col("_nb").isNotNull(), F.pmod(salt_of, F.col("_nb"))).otherwise(F.lit(0)))
         .drop("_nb"))
    s = (small.join(hot_b, key, "left")
         .withColumn("_salt", F.explode(F.when(F.col("_nb").isNotNull(),
                                               F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1))
                                        .otherwise(F.array(F.lit(0).cast("long")))))
         .drop("_nb"))
    return b, s
