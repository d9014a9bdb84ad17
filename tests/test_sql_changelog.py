from clickflow.operators.changelog import changelog_count
from clickflow.operators.scan import block_of
from clickflow.sources import register_view, sql_over
from clickflow.sources.rows import click_rows
from clickflow.sources.tables import from_click_records
from checks import rows
from fixtures import CLICKS6


def test_sql_filter_and_count_f2(spark):
    c = from_click_records(click_rows(spark, CLICKS6))
    register_view(c, "EventTable")
    urls = spark.sql("SELECT url, user_id FROM EventTable WHERE user_id = 'Alice'")
    assert sorted(r.url for r in urls.collect()) == ["./home", "./prod?id=1", "./prod?id=7"]
    cnt = spark.sql("SELECT user_id, COUNT(url) AS url_count FROM EventTable GROUP BY user_id")
    assert rows(cnt) == [("Alice", 3), ("Bob", 2), ("Cary", 1)]
    proj = sql_over(spark, "SELECT url, user_id FROM {t}", t=c)
    assert proj.columns == ["url", "user_id"]


def test_changelog_f2(spark):
    c = from_click_records(click_rows(spark, CLICKS6))
    for blk in (1, 2, 1 << 16):
        out = changelog_count(c, "user_id", block_of("seq", blk)).orderBy("seq", "pos").collect()
        assert [(r.op, r.user_id, r.n) for r in out] == [
            ("+I", "Alice", 1), ("+I", "Bob", 1), ("-U", "Alice", 1), ("+U", "Alice", 2), ("+I", "Cary", 1),
            ("-U", "Bob", 1), ("+U", "Bob", 2), ("-U", "Alice", 2), ("+U", "Alice", 3)]


def test_count_skips_null_url(spark):
    c = from_click_records(click_rows(spark, [("u", None, 1), ("u", "/a", 2)]))
    register_view(c, "NullTable")
    assert rows(spark.sql("SELECT user_id, COUNT(url) AS n FROM NullTable GROUP BY user_id")) == [("u", 1)]
