from pyspark.sql import functions as F

from clickflow.operators import windows as W
from clickflow.operators.ranking import REPORT_RULE, report, top_n
from clickflow.sources.rows import click_rows
from clickflow.sources.tables import from_click_records
from checks import rows
from fixtures import CLICKS_WINDOW, ms


def test_tumbling_url_counts_f4(spark):
    c = from_click_records(click_rows(spark, CLICKS_WINDOW))
    out = W.url_counts(c, 10_000)
    start = ms(2023, 9, 6, 22, 1, 50)
    first = rows(out.filter(F.col("window_start") == start), "url", "cnt", "window_end")
    assert first == [("/a", 1, start + 10_000), ("/abc@a=1?", 2, start + 10_000),
                     ("/al/a?", 2, start + 10_000), ("/b/url/afs", 2, start + 10_000)]
    assert rows(out.filter(F.col("window_start") == start + 10_000), "url", "cnt") == [("/b", 1)]


def test_sliding_windows_cover_each_click_twice(spark):
    c = from_click_records(click_rows(spark, CLICKS_WINDOW))
    out = W.url_counts(c, 10_000, 5_000)
    assert out.agg(F.sum("cnt")).first()[0] == 2 * len(CLICKS_WINDOW)


def test_pv_uv(spark):
    c = from_click_records(click_rows(spark, [("a", "/x", 0), ("a", "/y", 1), ("b", "/x", 2), ("a", "/x", 6000)]))
    out = rows(W.pv_uv(c, 5_000), "window_start", "pv", "uv", "ratio")
    assert out == [(0, 3, 2, 1.5), (5000, 1, 1, 1.0)]


F5 = {  # window_end -> url counts (FIXTURES F5)
    1: {"/b/url/afs": 1, "/c": 1, "/b": 1},
    2: {"/al/a?": 1, "/b/url/afs": 1, "/b": 2, "/abc@a=1?": 1, "/c": 2, "/a": 1},
    3: {"/abc@a=1?": 2, "/al/a?": 2, "/b": 2, "/c": 2, "/a": 2},
    4: {"/c": 1, "/abc@a=1?": 3, "/al/a?": 3, "/b": 1, "/a": 2},
}


def test_top2_per_window_f5(spark):
    data = [(w, u, c) for w, m in F5.items() for u, c in m.items()]
    counts = spark.createDataFrame(data, "window_end long, url string, cnt long")
    got = rows(top_n(counts, 2), "window_end", "rk", "url", "cnt")
    assert got == [(1, 1, "/b", 1), (1, 2, "/b/url/afs", 1), (2, 1, "/b", 2), (2, 2, "/c", 2),
                   (3, 1, "/a", 2), (3, 2, "/abc@a=1?", 2), (4, 1, "/abc@a=1?", 3), (4, 2, "/al/a?", 3)]


def test_short_window_returns_what_it_has(spark):
    counts = spark.createDataFrame([(1, "/only", 5)], "window_end long, url string, cnt long")
    assert top_n(counts, 2).count() == 1


def test_report_text(spark):
    counts = spark.createDataFrame([(9, "/b", 2), (9, "/c", 2), (9, "/a", 1)], "window_end long, url string, cnt long")
    text = report(top_n(counts, 2)).first().report
    assert text == "No.1 url:/b 访问量:2\nNo.2 url:/c 访问量:2\n" + REPORT_RULE
