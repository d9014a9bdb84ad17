import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clickflow.operators import windows as W
from clickflow.operators.changelog import changelog_count
from clickflow.operators.scan import block_of
from clickflow.operators.timers import periodic_counts
from clickflow.schema import CLICK
from clickflow.session import local_path, scratch_path
from clickflow.sources.tables import clicks, click_view, from_click_records
from clickflow.streaming.processors import CHANGELOG_SCHEMA, PERIODIC_SCHEMA, ChangelogCounter, PeriodicCount
from clickflow.streaming.replay import events_replay
from clickflow.streaming.runner import ROCKSDB, run_available_now
from checks import SF_SMALL, rows

TWS = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}


def _late_files(spark):
    """E-late: three files, key a, ms {1000, 25000} / {2000, 26000} / {60000}."""
    d = local_path(scratch_path(spark, "test", "late"))
    os.makedirs(d)
    seq = 0
    for i, group in enumerate([[1000, 25000], [2000, 26000], [60000]]):
        t = pa.table({"seq": pa.array(range(seq, seq + len(group)), pa.int32()), "user": ["a"] * len(group),
                      "url": ["/x"] * len(group), "timestamp": pa.array(group, pa.int64())})
        seq += len(group)
        p = os.path.join(d, f"part-{i}.parquet")
        pq.write_table(t, p)
        os.utime(p, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return d


def _late_counts(spark, d, conf):
    s = spark.readStream.schema(CLICK).option("maxFilesPerTrigger", "1").parquet(d)
    c = from_click_records(s).withWatermark("ts", "0 seconds")
    g = c.groupBy(W.event_window(10_000).alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
    g = g.select(F.unix_millis(F.col("w.start")).alias("ws"), "cnt")
    res = run_available_now(g, "late_test", conf=conf)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in res.progress for op in p.get("stateOperators", []))
    return rows(res.rows(), "ws", "cnt"), dropped


def test_late_row_dropped_against_current_watermark(spark):
    d = _late_files(spark)
    got, dropped = _late_counts(spark, d, {"spark.sql.streaming.statefulOperator.allowMultiple": "false"})
    assert got == [(0, 1), (20000, 2)] and dropped == 1


def test_late_row_kept_by_default(spark):
    d = _late_files(spark)
    got, dropped = _late_counts(spark, d, None)
    assert got == [(0, 2), (20000, 2)] and dropped == 0


@pytest.mark.parametrize("chunks,files", [(4, 1), (3, 2)])
def test_stream_window_equals_batch(spark, chunks, files):
    """stream = batch on closed windows, for two batch sizes."""
    r = events_replay(spark, SF_SMALL, chunks, files)
    s = click_view(r.stream(spark)).withWatermark("ts", "0 seconds")
    got = run_available_now(W.url_counts(s, 3_600_000), f"twin_{chunks}").rows()
    b = clicks(spark, SF_SMALL)
    end = b.agg(F.max("ms")).first()[0]
    exp = W.url_counts(b, 3_600_000).filter(F.col("window_end") <= end)
    assert rows(got) == rows(exp.select(*got.columns))


def test_stream_changelog_equals_batch(spark):
    r = events_replay(spark, SF_SMALL, 4, 1)
    s = click_view(r.stream(spark)).withWatermark("ts", "0 seconds").select("seq", "url")
    t = s.groupBy("url").transformWithStateInPandas(statefulProcessor=ChangelogCounter(),
                                                    outputStructType=CHANGELOG_SCHEMA, outputMode="Append",
                                                    timeMode="None")
    got = run_available_now(t, "twin_changelog", conf=TWS).rows()
    exp = changelog_count(clicks(spark, SF_SMALL), "url", block_of("seq", 100))
    assert rows(got, "seq", "pos", "op", "url", "n") == rows(exp, "seq", "pos", "op", "url", "n")


def test_stream_periodic_equals_batch(spark):
    r = events_replay(spark, SF_SMALL, 3, 2)
    s = click_view(r.stream(spark)).withWatermark("ts", "0 seconds").select("user_id", "ms", "ts")
    t = s.groupBy("user_id").transformWithStateInPandas(statefulProcessor=PeriodicCount(86_400_000),
                                                        outputStructType=PERIODIC_SCHEMA, outputMode="Append",
                                                        timeMode="EventTime")
    got = run_available_now(t, "twin_periodic", conf=TWS).rows()
    exp = periodic_counts(clicks(spark, SF_SMALL), 86_400_000)
    assert rows(got, "user_id", "tick", "pv") == rows(exp, "user_id", "tick", "pv")


@pytest.mark.parametrize("chunks,files", [(4, 1), (2, 3)])
def test_stream_pv_uv_and_topn_equal_batch(spark, chunks, files):
    from clickflow.operators.ranking import top_n
    r = events_replay(spark, SF_SMALL, chunks, files)
    s = click_view(r.stream(spark)).withWatermark("ts", "0 seconds")
    b = clicks(spark, SF_SMALL)
    end = b.agg(F.max("ms")).first()[0]

    got = run_available_now(W.pv_uv(s, 3_600_000), f"pvuv_{chunks}").rows()
    exp = W.pv_uv(b, 3_600_000).filter(F.col("window_start") + 3_600_000 <= end)
    assert rows(got, "window_start", "pv", "uv", "ratio") == rows(exp, "window_start", "pv", "uv", "ratio")

    counts = W.url_counts(s, 7_200_000, 3_600_000)
    got = run_available_now(counts, f"topn_{chunks}", batch_fn=lambda d: top_n(d, 2)).rows()
    exp = top_n(W.url_counts(b, 7_200_000, 3_600_000).filter(F.col("window_end") <= end), 2)
    assert rows(got, "window_end", "url", "cnt", "rk") == rows(exp, "window_end", "url", "cnt", "rk")


@pytest.mark.parametrize("chunks,files", [(4, 1), (3, 2)])
def test_stream_changelog_totals_equal_batch(spark, chunks, files):
    from clickflow.streaming.keyed_totals import KeyedTotals, changelog_batch
    r = events_replay(spark, SF_SMALL, chunks, files)
    s = click_view(r.stream(spark)).select("seq", "url")
    totals = KeyedTotals(spark, "url", f"test_{chunks}")
    got = run_available_now(s, f"cl_{chunks}", batch_fn_id=lambda b, i: changelog_batch(b, i, totals)).rows()
    exp = changelog_count(clicks(spark, SF_SMALL), "url", block_of("seq", 100))
    assert rows(got, "seq", "pos", "op", "url", "n") == rows(exp, "seq", "pos", "op", "url", "n")


def test_timer_processor_equals_batch(spark):
    from clickflow.operators.timers import timer_per_event
    from clickflow.streaming.processors import TIMER_SCHEMA, TimerPerEvent
    r = events_replay(spark, SF_SMALL, 4, 1)
    s = click_view(r.stream(spark)).withWatermark("ts", "0 seconds").select("user_id", "ms", "ts")
    t = s.groupBy("user_id").transformWithStateInPandas(statefulProcessor=TimerPerEvent(10_000),
                                                        outputStructType=TIMER_SCHEMA, outputMode="Append",
                                                        timeMode="EventTime")
    got = run_available_now(t, "twin_timer", conf=TWS).rows()
    exp = timer_per_event(clicks(spark, SF_SMALL), 10_000)
    assert rows(got, "user_id", "kind", "at_ms") == rows(exp, "user_id", "kind", "at_ms")


def test_stream_tumbling_golden_f4(spark):
    """The reference's listing: window [22:01:50, 22:02:00) closes when the
    22:02:00 click arrives; the /b window stays open."""
    from clickflow.sources.rows import click_rows
    from clickflow.streaming.replay import write_replay
    from fixtures import CLICKS_WINDOW, ms as at
    recs = click_rows(spark, CLICKS_WINDOW)
    r = write_replay(spark, recs, "timestamp", "f4", 2, 1)
    s = from_click_records(r.stream(spark)).withWatermark("ts", "0 seconds")
    got = rows(run_available_now(W.url_counts(s, 10_000), "f4").rows(), "url", "cnt", "window_start")
    start = at(2023, 9, 6, 22, 1, 50)
    assert got == [("/a", 1, start), ("/abc@a=1?", 2, start), ("/al/a?", 2, start), ("/b/url/afs", 2, start)]


def test_replay_slices_cover_fractional_negative_values(spark):
    from clickflow.streaming.replay import slice_predicates
    df = spark.createDataFrame([(-2.5,), (-0.1,), (0.0,), (3.7,), (9.99,)], "x double")
    preds = slice_predicates(df, "x", 3)
    counts = [df.filter(p).count() for p in preds]
    assert sum(counts) == 5


def test_stream_restart_after_failure_is_exactly_once(spark):
    """Fail micro-batch 2 after its key totals are written but before its
    output is committed, restart from the checkpoint: output equals the
    batch result, with no duplicate and no missing row."""
    from clickflow.streaming.keyed_totals import KeyedTotals, changelog_batch
    r = events_replay(spark, SF_SMALL, 4, 1)
    paths = (scratch_path(spark, "test", "restart-out"), scratch_path(spark, "test", "restart-ckpt"))
    totals = KeyedTotals(spark, "url", "restart", path=scratch_path(spark, "test", "restart-totals"))

    def failing(b, i):
        out = changelog_batch(b, i, totals)
        if i == 2:
            raise RuntimeError("simulated executor loss")
        return out

    s = click_view(r.stream(spark)).select("seq", "url")
    with pytest.raises(Exception):
        run_available_now(s, "restart", batch_fn_id=failing, paths=paths)
    s = click_view(r.stream(spark)).select("seq", "url")
    got = run_available_now(s, "restart", batch_fn_id=lambda b, i: changelog_batch(b, i, totals), paths=paths).rows()
    exp = changelog_count(clicks(spark, SF_SMALL), "url", block_of("seq", 100))
    assert rows(got, "seq", "pos", "op", "url", "n") == rows(exp, "seq", "pos", "op", "url", "n")


def test_keyed_state_restart_after_failure(spark):
    class FailOnceCount(PeriodicCount):
        """Fails the first timer firing of the run once (a marker file records
        the attempt), as an executor loss in the middle of a batch would."""

        def __init__(self, period_ms, marker):
            super().__init__(period_ms)
            self.marker = marker

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            if not os.path.exists(self.marker):
                open(self.marker, "w").close()
                raise RuntimeError("simulated failure while firing timers")
            yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)

    r = events_replay(spark, SF_SMALL, 4, 1)
    paths = (scratch_path(spark, "test", "tws-out"), scratch_path(spark, "test", "tws-ckpt"))
    marker = os.path.join(local_path(scratch_path(spark, "test", "tws-marker")))

    def query():
        s = click_view(r.stream(spark)).withWatermark("ts", "0 seconds").select("user_id", "ms", "ts")
        return s.groupBy("user_id").transformWithStateInPandas(
            statefulProcessor=FailOnceCount(86_400_000, marker), outputStructType=PERIODIC_SCHEMA,
            outputMode="Append", timeMode="EventTime")

    with pytest.raises(Exception):
        run_available_now(query(), "tws_restart", conf=TWS, paths=paths)
    assert os.path.exists(marker)
    got = run_available_now(query(), "tws_restart", conf=TWS, paths=paths).rows()
    exp = periodic_counts(clicks(spark, SF_SMALL), 86_400_000)
    assert rows(got, "user_id", "tick", "pv") == rows(exp, "user_id", "tick", "pv")


def test_changelog_totals_null_key_across_batches(spark):
    from clickflow.streaming.keyed_totals import KeyedTotals, changelog_batch
    totals = KeyedTotals(spark, "url", "nullkey")
    b0 = spark.createDataFrame([(0, None), (1, "a"), (2, None)], "seq long, url string")
    b1 = spark.createDataFrame([(3, None), (4, "a"), (5, "b")], "seq long, url string")
    out0 = changelog_batch(b0, 0, totals).collect()
    out1 = changelog_batch(b1, 1, totals).collect()
    after = {(r.seq, r.op): r.n for r in out0 + out1 if r.op != "-U"}
    assert after == {(0, "+I"): 1, (1, "+I"): 1, (2, "+U"): 2, (3, "+U"): 3, (4, "+U"): 2, (5, "+I"): 1}
    assert sorted((r.url or "", r.total) for r in totals.before(2).collect()) == [("", 3), ("a", 2), ("b", 1)]


def test_map_side_combine_preserves_counts(spark):
    from clickflow.streaming.processors import combine_per_ms
    df = spark.createDataFrame([(1, 10), (1, 10), (1, 10), (2, 10), (1, 11)], "user_id long, ms long")
    # partial: per input partition; the totals per (user, ms) are preserved
    out = combine_per_ms(df)
    summed = out.groupBy("user_id", "ms").agg(F.sum("n").alias("n"))
    assert rows(summed, "user_id", "ms", "n") == [(1, 10, 3), (1, 11, 1), (2, 10, 1)]
    # within one partition the rows collapse fully
    one = combine_per_ms(df.coalesce(1))
    assert rows(one, "user_id", "ms", "n") == [(1, 10, 3), (1, 11, 1), (2, 10, 1)]
