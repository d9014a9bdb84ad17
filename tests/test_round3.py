"""Logs of increments, due ticks, late rows, exact file rolls, bucketed snapshots, user aggregates."""

import random

import pytest
from pyspark.sql import functions as F

from clickflow.operators import windows as W
from clickflow.operators.timers import periodic_counts
from clickflow.operators.udf import PvUv, UserAggregate, aggregate_with
from clickflow.session import hadoop_path, path_exists, scratch_path
from clickflow.sinks import upsert as U
from clickflow.sinks.rolling import read_rolled, rolled_batch, with_parts, write_rolled
from clickflow.sources.tables import click_view, clicks
from clickflow.streaming.due_ticks import DueTicks
from clickflow.streaming.keyed_log import KeyedLog
from clickflow.streaming.replay import events_replay
from clickflow.streaming.runner import batch_clock, run_available_now
from checks import SF_SMALL, rows


def names(spark, path):
    fs, p = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


# ------------------------------------------------------------------ keyed log

def test_keyed_log_sums_over_compactions(spark):
    log = KeyedLog(spark, "t", "k string, n long, first long", ["k"], {"n": "sum", "first": "min"}, every=3)
    rnd, want = random.Random(1), {}
    for i in range(11):
        assert {r.k: (r.n, r["first"]) for r in log.before(i).collect()} == want
        add = [(rnd.choice(["a", "b", None]), rnd.randint(1, 9), rnd.randint(0, 99)) for _ in range(4)]
        for _ in range(2 if i in (2, 5, 7) else 1):   # batches that run twice
            log.write(i, spark.createDataFrame(add, log.schema))
        for k, n, f in add:
            a, b = want.get(k, (0, 99))
            want[k] = (a + n, min(b, f))
    assert names(spark, log.path) == ["base=5", "base=8", "log=10", "log=6", "log=7", "log=8", "log=9"]


def test_keyed_log_misses_nothing_silently(spark):
    log = KeyedLog(spark, "t", "k string, n long", ["k"], {"n": "sum"}, every=3)
    log.write(0, spark.createDataFrame([("a", 1)], log.schema))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        log.before(2).collect()


# ------------------------------------------------------------------- due ticks

def reported(spark, data, edges, period, every=3):
    """All rows of the batches of `data` cut at `edges` (event times)."""
    ticks = DueTicks(spark, "t", period, every=every)
    out, wm = [], 0
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        part = spark.createDataFrame([r for r in data if lo <= r[1] < hi], "user_id long, ms long, seq long")
        got = ticks.batch(part, i, wm)
        assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
        out += [tuple(r) for r in got.collect()]
        wm = max([wm] + [r[1] for r in data if r[1] < hi])
    ticks.close()
    return sorted(out)


def batch_form(spark, data, period):
    df = spark.createDataFrame(data, "user_id long, ms long, seq long")
    return sorted(tuple(r) for r in periodic_counts(df, period).select("user_id", "tick", "pv").collect())


@pytest.mark.parametrize("batches", [1, 2, 9])
def test_due_ticks_equal_the_batch_form(spark, batches):
    rnd = random.Random(2)
    times = sorted(rnd.randint(1, 50_000) for _ in range(300))
    data = [(1 if rnd.random() < 0.4 else rnd.randint(2, 12), t, i) for i, t in enumerate(times)]
    edges = [0] + [50_001 * (b + 1) // batches for b in range(batches)]
    got = reported(spark, data, edges, 1000)
    assert len(got) == len(set(got)) and got == batch_form(spark, data, 1000)


def test_due_ticks_over_a_silent_year(spark):
    year = 365 * 86_400_000
    data = [(1, 1000, 0), (2, 5000, 1), (1, 1000 + year, 2), (2, 9000 + year, 3), (None, 7000, 4)]
    ticks = DueTicks(spark, "year", 60_000)
    first = spark.createDataFrame([r for r in data if r[1] < year], "user_id long, ms long, seq long")
    assert ticks.batch(first, 0, 0).count() == 0
    rest = ticks.batch(spark.createDataFrame(data[2:4], "user_id long, ms long, seq long"), 1, 7000)
    got = rest.groupBy("user_id").agg(F.count("*").alias("n"), F.min("pv").alias("lo"), F.max("pv").alias("hi"), F.countDistinct("tick").alias("d"))
    assert rows(got) == [(1, 525_600, 1, 2, 525_600), (2, 525_600, 1, 1, 525_600)]
    ticks.close()


def test_late_clicks_go_to_the_next_tick(spark):
    ticks = DueTicks(spark, "late", 10)
    make = lambda *r: spark.createDataFrame([(u, ms, i) for i, (u, ms) in enumerate(r)], "user_id long, ms long, seq long")
    assert rows(ticks.batch(make((1, 0), (1, 25)), 0, 0)) == [(1, 10, 1), (1, 20, 1)]
    # ms 5 is late: ticks 10 and 20 were reported
    assert rows(ticks.batch(make((1, 5), (1, 41)), 1, 25)) == [(1, 30, 3), (1, 40, 3)]
    ticks.close()


def test_periodic_stream_resumes_from_its_checkpoint(spark):
    period, state = 3_600_000, scratch_path(spark, "test", "ticks")
    paths = (scratch_path(spark, "test", "ticks-out"), scratch_path(spark, "test", "ticks-ckpt"))
    failed = []

    def step(batch, batch_id, wm):
        ticks = DueTicks(spark, "resume", period, path=state)
        out = ticks.batch(batch, batch_id, wm)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise ValueError("lost")   # after the logs were written
        return out

    s = click_view(events_replay(spark, SF_SMALL, 4, 2).stream(spark)).withWatermark("ts", "0 seconds").select("user_id", "ms", "seq", "ts")
    with pytest.raises(Exception, match="lost"):
        run_available_now(s, "resume", batch_fn_clock=step, paths=paths)
    got = run_available_now(s, "resume", batch_fn_clock=step, paths=paths).rows()
    assert failed == [2] and rows(got, "user_id", "tick", "pv") == rows(periodic_counts(clicks(spark, SF_SMALL), period), "user_id", "tick", "pv")


# ------------------------------------------------------- clock and late rows

@pytest.mark.parametrize("chunks", [4, 25])
def test_batch_clock_is_the_watermark_of_each_batch(spark, chunks):
    s = click_view(events_replay(spark, SF_SMALL, chunks, 1).stream(spark)).withWatermark("ts", "0 seconds")
    paths = (scratch_path(spark, "test", "wm-out"), scratch_path(spark, "test", "wm-ckpt"))
    res = run_available_now(s.select("seq", "ms", "ts"), "wm", paths=paths, batch_fn_clock=lambda b, i, wm: b.select(
        "seq", "ms", F.lit(i).cast("long").alias("batch"), F.lit(wm).cast("long").alias("wm")))
    got = res.rows().groupBy("batch").agg(F.min("wm").alias("lo"), F.max("wm").alias("hi"), F.max("ms").alias("latest")).orderBy("batch").collect()
    assert len(got) == chunks and all(r.lo == r.hi for r in got)
    assert [r.lo for r in got] == [0] + [max(g.latest for g in got[:i]) for i in range(1, chunks)]
    assert batch_clock(spark, paths[1], 1)[1] > 1_600_000_000_000


def test_split_late_parts_the_rows(spark):
    df = spark.createDataFrame([(0,), (9,), (10,), (19,), (20,), (None,)], "ms long")
    on_time, late = W.split_late(df, 20, 10)
    assert rows(late) == [(0,), (9,), (10,), (19,)] and sorted(str(r.ms) for r in on_time.collect()) == ["20", "None"]
    assert W.split_late(df, 0, 10)[1].count() == 0


# --------------------------------------------------------------- rolling files

def lines(spark, n, seed=3):
    rnd = random.Random(seed)
    data = [(i, rnd.choice(["a", "a", "b"]), "é" * rnd.randint(0, 9) + str(i)) for i in range(n)]
    return data, spark.createDataFrame(data, "seq long, bucket string, value string")


def test_parts_hold_the_roll_size_within_a_line(spark):
    data, df = lines(spark, 600)
    out = scratch_path(spark, "test", "rolled")
    write_rolled(df, out, "seq", 200)
    got = read_rolled(spark, out).collect()
    assert sorted((r.bucket, r.value) for r in got) == sorted((b, v) for _, b, v in data)
    sizes = {}
    for r in got:
        sizes[r.bucket, r.part] = sizes.get((r.bucket, r.part), 0) + len(r.value.encode()) + 1
    for b in "ab":
        parts = sorted(p for x, p in sizes if x == b)
        assert parts == list(range(len(parts))) and all(200 - 24 < sizes[b, p] < 200 + 24 for p in parts[:-1])
    assert all(len([n for n in names(spark, f"{out}/batch_id=0/bucket={b}/part={p}") if n.startswith("part-")]) == 1 for b, p in sizes)
    # in order, and the input is read once
    whole = {b: [v for _, x, v in data if x == b] for b in "ab"}
    assert {b: [v for p in sorted(p for x, p in sizes if x == b) for v in spark.read.text(f"{out}/batch_id=0/bucket={b}/part={p}").toPandas()["value"]]
            for b in "ab"} == whole


def test_parts_go_on_over_batches_and_roll_when_idle(spark):
    log = KeyedLog(spark, "roll", "bucket string, bytes long, last_ms long", ["bucket"], {"bytes": "sum", "last_ms": "max"}, every=2)
    out = scratch_path(spark, "test", "rolled")
    make = lambda *r: spark.createDataFrame([(i, b, v) for i, (b, v) in enumerate(r)], "seq long, bucket string, value string")
    four = "xyz"   # 4 bytes with the line's end
    steps = [(make(("a", four), ("b", four)), 1000), (make(("a", four), ("a", four), ("a", "late")), 2000),
             (make(("b", four)), 90_000), (make(("a", "new")), 90_000)]
    for i, (batch, clock) in enumerate(steps):
        for _ in range(2 if i == 1 else 1):   # a batch that runs twice
            rolled_batch(batch, i, clock, log, out, "seq", 12, 60_000)
    got = sorted((r.bucket, r.part, r.value) for r in read_rolled(spark, out).collect())
    # a: three lines fill part 0, then part 1; b was idle for over a minute, and so was a
    assert got == [("a", 0, four)] * 3 + [("a", 1, "late"), ("a", 2, "new"), ("b", 0, four), ("b", 1, four)]


def test_parts_need_one_scan(spark):
    c = clicks(spark, "/root/testdata/sf0.01").select("seq", F.col("url").alias("value"), F.col("user_id").cast("string").alias("bucket"))
    p = with_parts(c, "seq", 1 << 20)
    p.collect()
    assert p._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan") == 1


# -------------------------------------------------------------- bucketed snapshot

def test_snapshot_rewrites_touched_buckets_only(spark):
    root = scratch_path(spark, "test", "snapshot")
    make = lambda *r: spark.createDataFrame(list(r), "k string, v string, at long")
    U.upsert_batch(make(*((f"k{i}", "old", 1) for i in range(60))), 0, root, ["k"], "at", buckets=8)
    before = U.read_manifest(spark, root, 0)
    assert sorted(before) == list(range(8))
    for _ in range(2):  # a batch that runs twice
        U.upsert_batch(make(("k7", "new", 2), ("k8", "late", 0)), 1, root, ["k"], "at", buckets=8)
    after = U.read_manifest(spark, root, 1)
    touched = {b for b in after if after[b] == 1}
    assert 1 <= len(touched) <= 2 and all(after[b] == 0 for b in after if b not in touched)
    assert {int(n[7:]) for n in names(spark, f"{root}/data/batch=1") if n.startswith("bucket=")} == touched
    U.upsert_batch(make(), 2, root, ["k"], "at", buckets=8)
    got = {r.k: r.v for r in U.read_snapshot(spark, root).collect()}
    assert len(got) == 60 and got["k7"] == "new" and got["k8"] == "old"
    # replaced folders are gone, the others are as they were
    assert {int(n[7:]) for n in names(spark, f"{root}/data/batch=0") if n.startswith("bucket=")} == set(range(8)) - touched
    fs, p = hadoop_path(spark, U.manifest_path(root, 2))
    fs.delete(p, False)
    with pytest.raises(RuntimeError, match="no manifest"):
        U.upsert_batch(make(("k1", "x", 9)), 3, root, ["k"], "at", buckets=8)
    assert not path_exists(spark, f"{root}/data/batch=3")


# ----------------------------------------------------------------- user aggregates

def longest():
    """An aggregate of this module, which workers can't import: it goes by value."""
    class Longest(UserAggregate):
        """Longest value and a set of lengths; order-free by the value itself."""

        def create(self):
            return "", set()

        def add(self, acc, rows):
            best, lengths = acc
            for v in rows["v"].dropna():
                best, lengths = max(best, v, key=lambda x: (len(x), x)), lengths | {len(v)}
            return best, lengths

        def merge(self, a, b):
            return max(a[0], b[0], key=lambda x: (len(x), x)), a[1] | b[1]

        def result(self, acc):
            return acc[0], len(acc[1])

    return Longest()


@pytest.mark.parametrize("parts,max_groups", [(1, 1000), (7, 2), (16, 1)])
def test_accumulators_merge_in_any_order(spark, parts, max_groups):
    rnd = random.Random(8)
    data = [(rnd.choice(["hot"] * 5 + ["x", "y", None]), rnd.choice([None, "a" * rnd.randint(0, 9), str(i)])) for i in range(400)]
    df = spark.createDataFrame(data, "g string, v string").repartition(parts)
    got = {r.g: (r.best, r.n) for r in aggregate_with(df, ["g"], longest(), "g string, best string, n long", max_groups).collect()}
    want = {}
    for g, v in data:
        best, lengths = want.setdefault(g, ("", set()))
        want[g] = (max(best, v, key=lambda x: (len(x), x)), lengths | {len(v)}) if v is not None else (best, lengths)
    assert got == {g: (b, len(n)) for g, (b, n) in want.items()}
    agg = PvUv()
    assert agg.result(agg.merge(agg.merge((1, {1}), (2, {2})), (3, {1}))) == agg.result(agg.merge((1, {1}), agg.merge((2, {2}), (3, {1})))) == (6, 2, 3.0)


def test_aggregate_of_an_empty_input(spark):
    df = spark.createDataFrame([], "g string, v string")
    assert aggregate_with(df, ["g"], longest(), "g string, best string, n long").collect() == []
