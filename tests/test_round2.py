"""Cases from the review: exact string ends, strict parse under pruning, sums with
nulls, file order, byte rolls, nulls in the rich mapper, replay of bursty tables,
lost stream output, the upsert sink, the console sink."""

import os

import pytest
from pyspark.sql import functions as F

from clickflow.functions.strings import java_split, java_trim
from clickflow.jobs import load_clicks
from clickflow.operators import aggregates as A
from clickflow.operators import transforms as P
from clickflow.operators.scan import block_of
from clickflow.operators.udf import LengthMapper, map_rich
from clickflow.session import hadoop_path, path_exists, scratch_path
from clickflow.sinks import console, records_for_bytes
from clickflow.sinks.upsert import read_snapshot, upsert_stream
from clickflow.sources.text import read_lines
from clickflow.streaming import replay
from clickflow.streaming.runner import run_available_now


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "v string").select(col.alias("o")).first().o


def test_split_and_trim_reach_the_very_end(spark):
    assert one(spark, java_split(F.col("v"), ", "), ", \n") == ["", "\n"]
    for end in ("\u0085", " ", " "):
        assert one(spark, java_trim(F.col("v")), f" x {end}") == f"x {end}"
    assert one(spark, java_trim(F.col("v")), "\t x \r\n") == "x"


def test_strict_parse_fails_whatever_is_selected(spark):
    lines = spark.createDataFrame([(1, "mary,./a, 1000"), (2, "bob,./b")], "seq long, value string")
    for use in (lambda d: d.select("user").collect(), lambda d: d.count(), lambda d: d.collect()):
        with pytest.raises(Exception, match="malformed click line"):
            use(P.parse_click_csv(lines))
    assert P.parse_click_csv(lines.limit(1)).collect()[0][1:] == ("mary", "./a", 1000)


def test_running_sum_with_nulls(spark):
    for values, want in (([None, 5, None, 7], [None, 5, 5, 12]), ([None, None, 5, 7], [None, None, 5, 12]), ([1, None, None, None, 2], [1, 1, 1, 1, 3])):
        df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, seq long, v long")
        got = A.running_sum(df, "k", ["seq"], F.col("v"), "s", block_of("seq", 2)).orderBy("seq").collect()
        assert [r.s for r in got] == want


def test_files_are_read_in_name_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("u0,./first, 1\r\n")
    (tmp_path / "b.csv").write_text("".join(f"u{i},./x, {i}\n" for i in range(1, 500)))
    clicks = load_clicks(spark, f"file://{tmp_path}/*.csv").orderBy("seq").collect()
    assert [r.seq for r in clicks] == list(range(500))
    assert [r.ms for r in clicks] == [1, *range(1, 500)] and clicks[0].url == "./first"


def test_lines_end_at_line_feeds(spark, tmp_path):
    (tmp_path / "t.txt").write_bytes(b"a\rb\r\nc\nd\r")
    assert [r.value for r in read_lines(spark, f"file://{tmp_path}/t.txt").collect()] == ["a\rb", "c", "d"]


def test_roll_size_counts_bytes(spark):
    df = spark.createDataFrame([("漢" * 100,)], "value string")
    assert records_for_bytes(df, "value", 1 << 20) == (1 << 20) // 301


def test_rich_mapper_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "seq long, url string")
    assert [(r.seq, r.len) for r in map_rich(df, LengthMapper, "seq long, len int").collect()] == [(1, 3), (2, None)]


@pytest.mark.parametrize("times", [[1, 2, 3, 4, 5, 1000, 1001, 1002], [7], [], [1] * 200 + [100]])
def test_replay_of_gaps_and_bursts(spark, times):
    df = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "t long, seq long")
    r = replay.write_replay(spark, df, "t", "bursty", chunks=4, min_files_per_chunk=2, rows_per_file=50)
    fs, p = hadoop_path(spark, r.path)
    assert sum(s.getPath().getName().startswith("part-") for s in fs.listStatus(p)) == 4 * r.files_per_chunk
    out = run_available_now(r.stream(spark), "bursty")
    assert sorted(x.seq for x in out.rows().collect()) == list(range(len(times)))


def test_lost_output_is_an_error(spark):
    df = spark.createDataFrame([(1,), (2,)], "t long")
    out = run_available_now(replay.write_replay(spark, df, "t", "lost").stream(spark), "lost")
    fs, p = hadoop_path(spark, out.path)
    assert path_exists(spark, out.path)
    fs.delete(p, True)
    with pytest.raises(RuntimeError, match="which is gone"):
        out.rows()


def test_scheme_less_paths_are_the_default_file_systems(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    (tmp_path / "there").mkdir()
    conf.set("fs.viewfs.mounttable.t.link./x", f"file://{tmp_path}")
    conf.set("fs.defaultFS", "viewfs://t/")
    try:
        assert path_exists(spark, "/x/there") and not path_exists(spark, str(tmp_path / "there"))
    finally:
        conf.set("fs.defaultFS", old) if old else conf.unset("fs.defaultFS")


def test_upsert_stream_resumes(spark, tmp_path):
    src, root, ckpt = tmp_path / "in", scratch_path(spark, "test", "upsert"), scratch_path(spark, "test", "upsert-ckpt")
    src.mkdir()
    for i, text in enumerate(["a,1\nb,1\n", "a,2\n"]):
        (src / f"{i}.txt").write_text(text)
        s = spark.readStream.text(f"file://{src}").select(F.split("value", ",")[0].alias("k"), F.split("value", ",")[1].cast("long").alias("at"))
        q = upsert_stream(s, root, ckpt, ["k"], "at")
        q.awaitTermination()
        assert q.exception() is None
    assert sorted((r.k, r["at"]) for r in read_snapshot(spark, root).collect()) == [("a", 2), ("b", 1)]


def test_console_sink(spark, tmp_path):
    (tmp_path / "x.txt").write_text("hello\n")
    q = console(spark.readStream.text(f"file://{tmp_path}"), label="print-me")
    try:
        q.processAllAvailable()
        assert q.name == "print-me" and q.exception() is None and os.listdir(tmp_path)
    finally:
        q.stop()
