import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.operators.combine import co_map_union, keyed_join, salted_join
from clickflow.operators.timers import periodic_counts, timer_per_event
from clickflow.sources.rows import click_rows, keyed_rows, value_rows
from clickflow.sources.tables import from_click_records
from checks import rows
from fixtures import LEFT_PAIRS, RIGHT_PAIRS


def test_co_map_union_f7(spark):
    out = co_map_union(value_rows(spark, [1, 2, 3], T.IntegerType()), value_rows(spark, [1, 2, 3], T.LongType()), "v", "v")
    assert sorted(r.v for r in out.collect()) == sorted(["int:1", "int:2", "int:3", "Long:1", "Long:2", "Long:3"])


def test_keyed_join_f6(spark):
    l = keyed_rows(spark, LEFT_PAIRS).select("key", F.col("timestamp").alias("l"))
    r = keyed_rows(spark, RIGHT_PAIRS).select("key", F.col("timestamp").alias("r"))
    assert rows(keyed_join(l, r, "key")) == [("a", 1000, 1000), ("b", 2000, 2000)]


def test_salted_join_equals_plain_join_on_hot_key(spark):
    rnd = random.Random(3)
    big = spark.createDataFrame([(i, "hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 30)}") for i in range(2000)],
                                "id long, key string")
    small = spark.createDataFrame([(f"k{i}", i) for i in range(31)] + [("hot", -1)], "key string, attr long")
    plain = rows(big.join(small, "key"), "id", "key", "attr")
    salted = rows(salted_join(big, small, "key", F.xxhash64("id"), buckets=8, fraction=0.1), "id", "key", "attr")
    assert plain == salted


def test_timer_per_event(spark):
    c = from_click_records(click_rows(spark, [("a", "/x", 1000), ("a", "/y", 1000), ("b", "/x", 30000)]))
    out = rows(timer_per_event(c, 10_000), "user_id", "kind", "at_ms")
    assert out == [("a", "data", 1000), ("a", "data", 1000), ("a", "timer", 11000), ("b", "data", 30000)]
    msg = timer_per_event(c, 10_000).filter("kind = 'timer'").first().msg
    assert msg == "a,定时器触发时间:1970-01-01 00:00:11.0"


def test_periodic_counts_gap(spark):
    # user a clicks at 0 and 25 s, then is silent; b's late clicks extend the watermark
    c = from_click_records(click_rows(spark, [("a", "/", 0), ("a", "/", 25_000), ("b", "/", 1_000), ("b", "/", 62_000)]))
    out = rows(periodic_counts(c, 10_000), "user_id", "tick", "pv")
    assert [r for r in out if r[0] == "a"] == [("a", 10_000, 1), ("a", 20_000, 1), ("a", 30_000, 2),
                                               ("a", 40_000, 2), ("a", 50_000, 2), ("a", 60_000, 2)]
    assert [r for r in out if r[0] == "b"][-1] == ("b", 61_000, 1)


def test_bounded_keyed_join_stream_equals_batch(spark):
    from clickflow.operators.combine import keyed_join_within
    from clickflow.streaming.replay import write_replay
    from clickflow.streaming.runner import run_available_now

    rnd = random.Random(5)
    lrows = [(f"k{rnd.randint(0, 3)}", "L", rnd.randint(0, 120_000)) for _ in range(300)]
    rrows = [(f"k{rnd.randint(0, 3)}", "R", rnd.randint(0, 120_000)) for _ in range(300)]

    def prep(df, name):
        return df.select(F.col("key"), F.col("seq").alias(f"{name}_seq"), F.col("timestamp").alias(f"{name}_ms"),
                         F.timestamp_millis("timestamp").alias(f"{name}_ts"))

    lb, rb = prep(keyed_rows(spark, lrows), "l"), prep(keyed_rows(spark, rrows), "r")
    batch = keyed_join_within(lb, rb, "key", "l_ts", "r_ts", 5_000).select("l_seq", "r_seq")
    lr = write_replay(spark, lb, "l_ms", "bl", 3, 1)   # both inputs arrive in event-time order
    rr = write_replay(spark, rb, "r_ms", "br", 3, 1)
    ls = lr.stream(spark).withWatermark("l_ts", "0 seconds")
    rs = rr.stream(spark).withWatermark("r_ts", "0 seconds")
    res = run_available_now(keyed_join_within(ls, rs, "key", "l_ts", "r_ts", 5_000).select("l_seq", "r_seq"),
                            "bounded_join")
    assert rows(res.rows()) == rows(batch) and len(rows(batch)) > 0


def test_salted_left_join_keeps_unmatched_once(spark):
    big = spark.createDataFrame([(i, "hot" if i % 2 else "lonely") for i in range(200)], "id long, key string")
    small = spark.createDataFrame([("hot", 1)], "key string, attr long")
    plain = rows(big.join(small, "key", "left"), "id", "key", "attr")
    salted = rows(salted_join(big, small, "key", F.xxhash64("id"), buckets=4, fraction=0.1, how="left"),
                  "id", "key", "attr")
    assert plain == salted
    import pytest
    with pytest.raises(ValueError):
        salted_join(big, small, "key", F.xxhash64("id"), how="full")


def test_hot_key_list_is_bounded_by_fraction(spark):
    from clickflow.operators.combine import hot_keys
    rnd = random.Random(9)
    df = spark.createDataFrame([(f"k{int(rnd.paretovariate(1.2)) % 500}",) for _ in range(5000)], "key string")
    for fraction in (0.5, 0.1, 0.02):
        hk = hot_keys(df, "key", fraction).collect()
        assert len(hk) <= int(1 / fraction)
        assert all(r._n > 5000 * fraction for r in hk)


def test_salted_stream_join_with_hot_key_equals_batch(spark):
    from clickflow.operators.combine import hot_keys, salt_inputs
    from clickflow.streaming.replay import write_replay
    from clickflow.streaming.runner import run_available_now

    rnd = random.Random(21)
    clicks = [(i, "hot" if rnd.random() < 0.4 else f"u{rnd.randint(0, 20)}", 1000 + 7 * i) for i in range(600)]
    left_b = spark.createDataFrame(clicks, "seq long, user string, ms long").withColumn("ts", F.timestamp_millis("ms"))
    first_b = left_b.groupBy("user").agg(F.min("ms").alias("right_ms"))
    exp = rows(left_b.join(first_b, "user").select("seq", "user", "right_ms"))
    hot = spark.createDataFrame(hot_keys(left_b, "user", 0.1).collect(), "user string, _n long")
    assert hot.count() == 1
    lr = write_replay(spark, left_b, "ms", "salt_l", 3, 1)
    rr = write_replay(spark, first_b, "right_ms", "salt_r", 2, 1)
    ls = lr.stream(spark).withWatermark("ts", "0 seconds")
    rs = rr.stream(spark).withColumn("right_ts", F.timestamp_millis("right_ms")).withWatermark("right_ts", "0 seconds")
    l, r = salt_inputs(ls, rs, "user", F.xxhash64("seq"), hot, buckets=4)
    l, r = l.alias("l"), r.alias("r")
    cond = (F.col("l.user") == F.col("r.user")) & (F.col("l._salt") == F.col("r._salt")) & (F.col("r.right_ts") <= F.col("l.ts"))
    j = l.join(r, cond).select("seq", F.col("l.user").alias("user"), "right_ms")
    assert rows(run_available_now(j, "salted_stream").rows()) == exp


def test_history_join_pairs_each_row_once_whenever_it_comes(spark):
    """Right rows that come after, with and before their left rows, twice for one key, null keys, a batch that
    runs again; and no keyed state."""
    from clickflow.streaming.history_join import HistoryJoin, tagged

    left = [[(1, 10), (2, 11), (None, 12)], [(1, 13), (3, 14)], [(2, 15)]]
    right = [[(1, 5)], [(2, 6), (None, 7)], [(3, 8), (1, 9)]]
    h = HistoryJoin(spark, "history-test", ["k", "seq"], ["k", "r"], lambda a, b: a.join(b, "k").select("k", "seq", "r"))
    got = {}
    for i in (0, 1, 1, 2):
        batch = tagged(spark.createDataFrame(left[i], "k long, seq long"), spark.createDataFrame(right[i], "k long, r long"))
        got[i] = rows(h.batch(batch, i))
    every = [[x for b in side for x in b] for side in (left, right)]
    assert sorted(sum(got.values(), [])) == sorted((k, s, r) for k, s in every[0] for j, r in every[1] if k is not None and k == j)


def test_stream_keyed_join_keeps_no_state(spark, monkeypatch):
    from clickflow.plans import REGISTRY, streams
    from checks import SF_SMALL

    seen = []
    monkeypatch.setattr(streams, "run_available_now", lambda *a, _run=streams.run_available_now, **k: seen.append(_run(*a, **k)) or seen[-1])
    got = REGISTRY["stream_keyed_join"].build(spark, SF_SMALL)
    assert rows(got) == rows(REGISTRY["keyed_join"].build(spark, SF_SMALL).select(*got.columns))
    assert seen[0].progress and not any(p["stateOperators"] for p in seen[0].progress)
