"""Running (prefix) aggregates that stay distributed under key skew.

A streaming ``keyBy(k).sum/max/reduce`` emits one updated row per input row,
i.e. a prefix aggregate per key in arrival order.  The textbook Spark form,
``agg.over(Window.partitionBy(k).orderBy(seq))``, sends every row of a key to
one task; with one key holding a third of the data (or no key at all) that is
one task for a third of the data.

``prefix_scan`` splits each key's sequence into *blocks* given by a monotone
block expression of the order key (e.g. ``floor(seq / 65536)``) and deals rows
out by (key, block) once.  Both uses of the rows read that one exchange:

1. one summary row per (key, block)          -- aggregate within those partitions
2. exclusive prefix over the block summaries -- window over #blocks rows/key
3. the prefix goes back to its (key, block) as one more row, before all others
4. running aggregate per (key, block)        -- window over <= block-size rows

so the input is read (and its text parsed or tokenised) once, its rows are
shuffled and sorted once, and the two other shuffles are of summaries.  Spark
reuses an exchange only where both uses need the same columns; the summary
names them all (``_held``).  Rows and prefixes are united, not joined: both
are dealt out by the same key, which a union keeps.

Every combine is associative (sum, max, min, first), so the result equals the
single-window form.  Work per task is bounded by the block size and by the
number of blocks of one key, never by the size of a key.

``expanded_scan`` does the same where each input row makes many rows (the words of a
text): it deals out the input, by block alone, and makes the rows afterwards.

``running_best`` is the global arg-max of running counts in one pass: see there.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min, "first": F.first}

DEFAULT_BLOCK = 1 << 16
NULL_BLOCK = -(1 << 62)
#: Planned bytes of an input that is expanded in one task.
TASK_BYTES = 8 << 20


def block_of(order_col: str | Column, size: int | Column = DEFAULT_BLOCK) -> Column:
    c = F.col(order_col) if isinstance(order_col, str) else order_col
    s = size if isinstance(size, Column) else F.lit(size)
    return F.floor(c / s).cast("long")


def adaptive_block(df: DataFrame, order_col: str, floor: int = 4096, row_bytes: int = 16) -> Column:
    """Block expression whose width follows the size of ``df``: the square root
    of its estimated rows (the planner's size over ``row_bytes``), as a power
    of two, at least ``floor``.  With a dense order column a block then holds
    about sqrt(N) rows and a key spans about sqrt(N) blocks, so both windows
    of the scan stay near sqrt(N) rows per task, whatever the skew.  Nothing
    is read for it; where the planner has no size, ``DEFAULT_BLOCK`` is used.
    Any width gives the same result."""
    size = planned_bytes(df)
    if size is None:
        return block_of(order_col, max(floor, DEFAULT_BLOCK))
    width = 1 << math.ceil(math.log2(max(1.0, math.sqrt(size / row_bytes))))
    return block_of(order_col, max(floor, width))


def planned_bytes(df: DataFrame) -> int | None:
    """The planner's size of ``df``; nothing is read for it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else None


def _key_columns(df: DataFrame, keys: Sequence[str]) -> tuple[list[Column], list[str]]:
    """Non-null stand-ins for the nullable key columns, so the scan's join is a plain
    equi-join on the window's own partitioning and null keys still form their
    own group: a nullable string/number key becomes (coalesced value, is-null
    flag); other nullable types are wrapped in a struct (struct equality
    treats null fields as equal)."""
    cols, names = [], []
    for i, k in enumerate(keys):
        f = df.schema[k]
        if not f.nullable:
            names.append(k)
        elif isinstance(f.dataType, (T.StringType, T.NumericType, T.BooleanType)):
            default = F.lit("") if isinstance(f.dataType, T.StringType) else F.lit(0).cast(f.dataType)
            cols += [F.coalesce(F.col(k), default).alias(f"_k{i}"), F.col(k).isNull().alias(f"_n{i}")]
            names += [f"_k{i}", f"_n{i}"]
        else:
            cols.append(F.struct(F.col(k)).alias(f"_k{i}"))
            names.append(f"_k{i}")
    return cols, names


def _held(columns: Sequence[str]) -> Column:
    """Null, at the price of one comparison a row: no block has that number,
    so nothing is hashed, but the columns stay in the summary's input."""
    return F.max(F.when(F.col("_blk") == F.lit(NULL_BLOCK - 1), F.xxhash64(*columns))).alias("_held")


def prefix_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column,
                specs: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add one running-aggregate column per ``specs`` entry.

    ``specs``: output name -> (kind, expression), kind in sum/max/min/first.
    ``order`` must be a total order within a key; ``block`` must be
    non-decreasing in it.  ``keys`` may be empty (one global sequence).
    """
    kcols, kparts = _key_columns(df, keys)
    part = [*kparts, "_blk"]
    # a null order value sorts first, so its rows go to a block before all others
    d = df.select("*", *kcols, F.coalesce(block, F.lit(NULL_BLOCK)).alias("_blk")).repartition(*part)
    return _scan(d, df.columns, kparts, part, order, specs, df.columns)


def expanded_scan(df: DataFrame, expand: Callable[[DataFrame], DataFrame], keys: Sequence[str], order: Sequence[str],
                  block: Column, specs: dict[str, tuple[str, Column]]) -> DataFrame:
    """``prefix_scan`` over the many rows that ``expand`` makes of each row of ``df``.

    ``expand`` takes the rows of ``df`` and their block ``_blk`` and keeps ``_blk``; ``block``
    and the first ``order`` column are of ``df``.  The rows are dealt by block before they
    are expanded, in tasks of about ``TASK_BYTES``, so what is shuffled is the input and one
    summary per (key, block), not the rows made.  Each block is expanded twice."""
    size, spark = planned_bytes(df), df.sparkSession
    tasks = (int(spark.conf.get("spark.sql.shuffle.partitions")) if size is None
             else max(spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES)))
    dealt = df.withColumn("_blk", F.coalesce(block, F.lit(NULL_BLOCK))).repartition(tasks, "_blk")
    rows = expand(dealt)
    kcols, kparts = _key_columns(rows, keys)
    columns = [c for c in rows.columns if c != "_blk"]
    return _scan(rows.select("*", *kcols), columns, kparts, [tasks, "_blk"], order, specs, order[:1])


def _scan(d: DataFrame, columns: Sequence[str], kparts: Sequence[str], dealt: Sequence[str | int], order: Sequence[str],
          specs: dict[str, tuple[str, Column]], held: Sequence[str]) -> DataFrame:
    """The scan of rows ``d`` that are dealt out by ``dealt``; ``held`` are columns that
    the summaries need only so as to share the rows' exchange."""
    for kind, _ in specs.values():
        if kind not in AGGREGATES:
            raise ValueError(f"unsupported running aggregate {kind!r}")
    part = [*kparts, "_blk"]
    ordc = [F.col(c) for c in order]

    summaries = []
    for name, (kind, expr) in specs.items():
        whole = F.min_by(expr, F.struct(*order)) if kind == "first" else AGGREGATES[kind](expr)
        summaries.append(whole.alias(f"_b_{name}"))
    blocks = d.groupBy(*part).agg(*summaries, _held(held))
    before = (Window.partitionBy(*kparts) if kparts else Window).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    prefixes = blocks.select(*part, "_held", F.count(F.lit(1)).over(before).alias("_n"),
                             *[AGGREGATES[kind](f"_b_{name}").over(before).alias(f"_v_{name}") for name, (kind, _) in specs.items()])
    # _held is null in every row; it is used, so that the optimizer keeps it
    prefixes = prefixes.where((F.col("_n") > 0) & F.col("_held").isNull())
    prefixes = prefixes.select(*part, *[f"_v_{n}" for n in specs], F.lit(0).alias("_row")).repartition(*dealt)
    rows = d.select("*", *[expr.alias(f"_v_{name}") for name, (_, expr) in specs.items()], F.lit(1).alias("_row"))
    both = rows.unionByName(prefixes, allowMissingColumns=True)
    so_far = Window.partitionBy(*part).orderBy("_row", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = [AGGREGATES[kind](f"_v_{name}").over(so_far).cast(blocks.schema[f"_b_{name}"].dataType).alias(name)
               for name, (kind, _) in specs.items()]
    kept = [c for c in columns if c not in specs]
    return both.select("_row", *kept, *running).where("_row = 1").select(*kept, *specs)


def running_best(df: DataFrame, key: str, block: Column, order: str = "seq", out: str = "cnt") -> DataFrame:
    """(order, key, out): after each record the key with the most records so
    far, and their number; of equal counts the newer record wins.

    One pass: rows are dealt out by block alone, so the counts of a (block,
    key) and the running best of a block come from the same partitions.

    1. per (block, key) the count; its exclusive prefix over the key's blocks
       is what the key brings into a block            -- shuffled by key, and back
    2. a record's count is that plus its place among the key's records in the
       block; a block's best is composed from these
    3. exclusive prefix over the blocks' bests        -- one row a block, and back

    Five shuffles, one of them of rows; the input is read once."""
    kcols, kparts = _key_columns(df, [key])
    rows = df.select(order, key, *kcols, F.coalesce(block, F.lit(NULL_BLOCK)).alias("_blk")).repartition("_blk")
    before = Window.partitionBy(*kparts).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_blk", *kparts).agg(F.count(F.lit(1)).alias("_n"), _held([order, key])).where(F.col("_held").isNull())
    brought = counts.select("_blk", *kparts, F.sum("_n").over(before).alias("_n"), F.lit(0).alias("_row")).where(F.col("_n") > 0)
    ones = rows.withColumns({"_n": F.lit(1).cast("long"), "_row": F.lit(1)})
    both = ones.unionByName(brought.repartition("_blk"), allowMissingColumns=True)
    in_block = Window.partitionBy("_blk", *kparts).orderBy("_row", order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best = F.struct(F.col("_c").alias("c"), F.col(order).alias("q"), F.col(key).alias("k"))
    counted = both.withColumn("_c", F.sum("_n").over(in_block)).where("_row = 1").select("_blk", order, best.alias("_s"))
    earlier = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    bests = counted.groupBy("_blk").agg(F.max("_s").alias("_s")).select("_blk", F.max("_s").over(earlier).alias("_s"))
    bests = bests.where(F.col("_s").isNotNull()).withColumn("_row", F.lit(0)).repartition("_blk")
    r = counted.withColumn("_row", F.lit(1)).unionByName(bests, allowMissingColumns=True)
    so_far = Window.partitionBy("_blk").orderBy("_row", order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumn("_m", F.max("_s").over(so_far)).where("_row = 1")
    return r.select(order, F.col("_m.k").alias(key), F.col("_m.c").alias(out))
