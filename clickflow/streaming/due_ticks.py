"""E8 + E10 on a stream without keyed state: the cumulative report as a table of due ticks.

Per user the report is fixed by the time of the first click and the number of clicks
filed under each tick (a click belongs to the first tick at or after it).  Both are kept
as logs of increments (``keyed_log``): first clicks merge by min, filed clicks by sum, and
a compaction folds all ticks that were reported into one.  A micro-batch

1. files its clicks (a user with over ``HOT_FRACTION`` of them is salted in the join with
   the first clicks) and counts them per (user, tick) before anything is shuffled by user,
2. finds each user's ticks that became due as the watermark moved over the batch,
3. sums the filed clicks per user in tick order and spreads each sum over the due ticks up
   to the next one with clicks, by ``sequence``, ``SPREAD`` ticks at a time: a silent year
   costs its output rows, and no long array.

The watermark before a batch is Spark's own (``runner.batch_clock``); after it, it has
moved to the batch's largest event time.  A click behind its user's reported ticks is filed
under the next one; a user whose first click comes late gets all ticks from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickflow.operators.combine import salted_join
from clickflow.operators.timers import HOT_FRACTION
from clickflow.session import scratch_path
from clickflow.streaming.keyed_log import KeyedLog

SPREAD = 4096


class DueTicks:
    """The report's state and its step; ``delay_ms`` is the watermark's delay.  Clicks
    without a key are left out, as in the batch form."""

    def __init__(self, spark: SparkSession, name: str, period_ms: int, key: str = "user_id", key_type: str = "long",
                 path: str | None = None, every: int = 10, delay_ms: int = 0):
        path = path or scratch_path(spark, "ticks", name)
        self.key, self.period, self.delay = key, period_ms, delay_ms
        self.first = KeyedLog(spark, name, f"{key} {key_type}, first_ms long", [key], {"first_ms": "min"}, f"{path}/first", every)
        self.filed = KeyedLog(spark, name, f"{key} {key_type}, k long, n long", [key, "k"], {"n": "sum"}, f"{path}/filed", every,
                              fold=self._fold)
        self._users: DataFrame | None = None

    def _fold(self, filed: DataFrame) -> DataFrame:
        """Clicks of reported ticks are filed under the last of these."""
        return filed.join(self._users.select(self.key, "due"), self.key).select(self.key, F.greatest("k", "due").alias("k"), "n")

    def close(self) -> None:
        if self._users is not None:
            self._users.unpersist()
            self._users = None

    def batch(self, batch: DataFrame, batch_id: int, watermark_ms: int) -> DataFrame:
        """(key, tick, pv) of the ticks that the batch makes due."""
        key, p = self.key, F.lit(self.period)
        seen = batch.where(F.col(key).isNotNull())
        n, latest = seen.agg(F.count(F.lit(1)), F.max("ms")).first()
        now_ms = max(watermark_ms, (latest or 0) - self.delay)

        def ticks(ms: int):
            return F.greatest(F.floor((F.lit(ms) - F.col("first_ms")) / p), F.lit(0)).cast("long")

        known = self.first.before(batch_id).withColumnRenamed("first_ms", "_old")
        own = seen.groupBy(key).agg(F.min("ms").alias("_own"), F.count(F.lit(1)).alias("_n"))
        users = known.join(own, key, "full").withColumn("first_ms", F.coalesce("_old", "_own"))
        done = F.when(F.col("_old").isNull(), F.lit(0).cast("long")).otherwise(ticks(watermark_ms))
        self.close()
        # read by every step below, and by the write of the caller: released with the next batch
        self._users = users = users.select(key, "first_ms", "_old", "_n", done.alias("done"), ticks(now_ms).alias("due")).persist()
        hot = users.where(F.col("_n") > n * HOT_FRACTION).select(key, "_n")   # at most 1 / HOT_FRACTION rows
        anchors = users.where("_n is not null").select(key, "first_ms", "done")
        k = F.greatest(F.ceil((F.col("ms") - F.col("first_ms")) / p), F.col("done") + 1).cast("long")
        filed = (salted_join(seen.select(key, "ms", "seq"), anchors, key, F.xxhash64("seq"), buckets=8, hot=hot)
                 .groupBy(key, k.alias("k")).agg(F.count(F.lit(1)).alias("n")))
        earlier = self.filed.before(batch_id)
        self.first.write(batch_id, users.where("_old is null").select(key, "first_ms"))
        self.filed.write(batch_id, filed)
        added = batch.sparkSession.read.schema(self.filed.schema).parquet(f"{self.filed.path}/log={batch_id}")
        due = self._due(earlier.unionByName(added), users)
        return due.select(key, (F.col("first_ms") + F.col("k") * p).alias("tick"), "pv")

    def _due(self, filed: DataFrame, users: DataFrame) -> DataFrame:
        """(key, first_ms, k, pv) of the ticks after ``done`` up to ``due``."""
        key = self.key
        waiting = users.where("due > done").select(key, "first_ms", "done", "due")
        starts = waiting.select(key, (F.col("done") + 1).alias("k"), F.lit(0).cast("long").alias("n"))
        marks = filed.unionByName(starts).groupBy(key, "k").agg(F.sum("n").alias("n"))
        marks = marks.join(waiting, key).where("k <= due")
        along = Window.partitionBy(key).orderBy("k")
        marks = marks.select(key, "first_ms", "done", "k", F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)).cast("long").alias("pv"),
                             (F.coalesce(F.lead("k").over(along), F.col("due") + 1) - 1).alias("last")).where("k > done")
        chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("last") - F.col("k")) / SPREAD).cast("long"))).alias("_c")
        lo = F.col("k") + F.col("_c") * SPREAD
        rows = marks.select(key, "first_ms", "k", "last", "pv", chunk)
        return rows.select(key, "first_ms", "pv", F.explode(F.sequence(lo, F.least(lo + SPREAD - 1, F.col("last")))).alias("k"))
