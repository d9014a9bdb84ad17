"""Event-time timer jobs (E5, E10): batch twins, and the stream form of E5.

A bounded input's final watermark is its largest event time; a timer fires
when the watermark reaches it.  Both jobs are rewritten as set operations:

* E5 (one timer per element at ts + delay): arrivals, plus one row per
  distinct (key, ts + delay) not later than the final watermark.
* E10 (cumulative PV per user every ``period``): each click goes to the first
  tick at or after it, counts are pre-aggregated per (user, tick), then a
  running sum runs over ticks.  No click is ever paired with a tick, and the
  window per user spans its ticks (time range / period), not its clicks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.timefmt import sql_timestamp_text
from clickflow.operators.combine import salted_join

HOT_FRACTION = 0.01   # users above this share of clicks are salted in the click-to-first join

# The reference's timer messages.
DATA_LABEL = ",数据时间戳:"
TIMER_LABEL = ",定时器触发时间:"
PV_LABEL = ",pv:"


def timer_per_event(clicks: DataFrame, delay_ms: int = 10_000, key: str = "user_id") -> DataFrame:
    watermark = clicks.agg(F.max("ms")).scalar()
    data = clicks.select(key, F.lit("data").alias("kind"), F.col("ms").alias("at_ms"))
    fired = (clicks.select(key, (F.col("ms") + F.lit(delay_ms)).alias("at_ms"))
             .filter(F.col("at_ms") <= watermark)
             .distinct()
             .select(key, F.lit("timer").alias("kind"), "at_ms"))
    out = data.unionByName(fired)
    label = F.when(F.col("kind") == "data", F.lit(DATA_LABEL)).otherwise(F.lit(TIMER_LABEL))
    return out.withColumn("msg", F.concat(F.col(key).cast("string"), label, sql_timestamp_text(F.col("at_ms"))))


def periodic_counts(clicks: DataFrame, period_ms: int, key: str = "user_id") -> DataFrame:
    """Rows (key, tick, pv) for ticks first+period, first+2*period, ...
    up to the final watermark; pv counts the key's clicks with ms <= tick."""
    end = clicks.agg(F.max("ms")).scalar()
    total = clicks.agg(F.count(F.lit(1))).scalar()
    stats = clicks.groupBy(key).agg(F.min("ms").alias("first_ms"), F.count(F.lit(1)).alias("_n"))
    first = stats.select(key, "first_ms")
    p = F.lit(period_ms)
    # a user with more than 1% of the clicks is salted in the click-to-first join
    hot = stats.filter(F.col("_n") > total * F.lit(HOT_FRACTION)).select(key, "_n")
    with_first = salted_join(clicks.select(key, "ms", "seq"), first, key, F.xxhash64("seq"),
                             buckets=8, hot=hot).select(key, "ms", "first_ms")
    k = F.greatest(F.ceil((F.col("ms") - F.col("first_ms")) / p), F.lit(1)).cast("long")
    per_tick = with_first.groupBy(key, k.alias("k")).agg(F.count(F.lit(1)).alias("c"))
    n_ticks = F.floor((end - F.col("first_ms")) / p).cast("long")
    ticks = (first.withColumn("n", n_ticks).filter(F.col("n") >= 1)
             .select(key, "first_ms", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("k")))
    w = Window.partitionBy(key).orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = ticks.join(per_tick, [key, "k"], "left")
    return joined.select(key, (F.col("first_ms") + F.col("k") * p).alias("tick"),
                         F.sum(F.coalesce(F.col("c"), F.lit(0))).over(w).cast("long").alias("pv"))


def pv_report_text(key: str = "user_id"):
    return F.concat(F.col(key).cast("string"), F.lit(PV_LABEL), F.col("pv").cast("string"))


def timer_per_event_stream(clicks: DataFrame, delay_ms: int = 10_000, key: str = "user_id") -> DataFrame:
    """E5 on a stream, without keyed state: a timer at ts + delay that fires
    once the watermark passes it is an append-mode aggregation on
    (key, fire time) with the watermark on the fire time (delay ``delay_ms``
    there equals the reference's zero delay on the event time).  Partial
    aggregation keeps a hot key spread over tasks; arrivals are stateless."""
    data = clicks.select(key, F.lit("data").alias("kind"), F.col("ms").alias("at_ms"))
    fire = (clicks.select(key, F.timestamp_millis(F.col("ms") + F.lit(delay_ms)).alias("fire_ts"))
            .withWatermark("fire_ts", f"{int(delay_ms)} milliseconds")
            .groupBy(key, "fire_ts").agg(F.count(F.lit(1)).alias("_n"))
            .select(key, F.lit("timer").alias("kind"), F.unix_millis("fire_ts").alias("at_ms")))
    out = data.unionByName(fire)
    label = F.when(F.col("kind") == "data", F.lit(DATA_LABEL)).otherwise(F.lit(TIMER_LABEL))
    return out.withColumn("msg", F.concat(F.col(key).cast("string"), label, sql_timestamp_text(F.col("at_ms"))))
