import pytest
from pyspark.sql import functions as F

from clickflow.functions.strings import java_split, java_trim
from clickflow.operators import transforms as P
from clickflow.sources.rows import click_rows, line_rows
from clickflow.sources.tables import from_click_records
from clickflow.sinks import json_documents
from checks import rows
from fixtures import CLICKS3, CLICKS7


@pytest.fixture()
def c3(spark):
    return from_click_records(click_rows(spark, CLICKS3))


def test_map_user_and_length(spark, c3):
    assert [r.user_id for r in P.map_field(c3, "user_id").orderBy("seq").collect()] == ["a", "b", "c"]
    assert [r.len for r in P.field_length(c3, "user_id").orderBy("seq").collect()] == [1, 1, 1]


def test_filter_user(spark, c3):
    out = P.filter_equals(c3, "user_id", "b").collect()
    assert [(r.user_id, r.url, r.ms) for r in out] == [("b", "./h", 1212)]


def test_flatmap_fields(spark, c3):
    out = P.flatmap_fields(c3).orderBy("seq", "pos").collect()
    assert [r.v for r in out] == ["a", "1000", "b", "1212", "c", "1231"]


def test_flatmap_conditional(spark, c3):
    out = P.flatmap_conditional(c3, "b").orderBy("seq", "pos").collect()
    assert [r.v for r in out] == ["a", "1000", "./h", "1212", "b", "1212", "c", "1231"]


def test_process_conditional(spark, c3):
    out = P.process_conditional(c3, "b").orderBy("seq", "pos").collect()
    assert [r.v for r in out][:3] == ["Event{user='a', url='./home', timestamp=1000}", "bclicks./h",
                                     "Event{user='b', url='./h', timestamp=1212}"]


def test_event_display_uses_utc(spark, c3):
    out = P.event_strings(c3).orderBy("seq").first()
    assert out.display == "Event{user='a', url='./home', timestamp=1970-01-01 00:00:01}"


def test_json_documents(spark):
    c7 = from_click_records(click_rows(spark, CLICKS7))
    docs = [r.doc for r in json_documents(c7).orderBy("seq").collect()]
    assert docs[:2] == ['{"a":"./home"}', '{"b":"./h"}'] and len(docs) == 7


@pytest.mark.parametrize("line,expected", [
    ("a  b ", ["a", "", "b"]), ("", [""]), ("   ", []), (" x", ["", "x"]), ("hello world", ["hello", "world"]),
])
def test_java_split_semantics(spark, line, expected):
    got = line_rows(spark, [line]).select(java_split(F.col("value"), " ").alias("a")).first().a
    assert got == expected


def test_java_split_comma(spark):
    got = line_rows(spark, ["a,b,,", ",,,", "x,,y"]).select(java_split(F.col("value"), ",").alias("a")).collect()
    assert [r.a for r in got] == [["a", "b"], [], ["x", "", "y"]]


def test_java_trim_strips_control_chars(spark):
    got = line_rows(spark, ["\t 1000 \n"]).select(java_trim(F.col("value")).alias("t")).first().t
    assert got == "1000"


def test_parse_csv(spark):
    lines = line_rows(spark, ["mary,./a, 1000", "x,y,1,z", "a,b,\t7\t"]).withColumn("seq", F.monotonically_increasing_id())
    out = rows(P.parse_click_csv(lines, strict=True), "user", "url", "timestamp")
    assert out == [("a", "b", 7), ("mary", "./a", 1000), ("x", "y", 1)]


def test_parse_csv_strict_fails(spark):
    lines = line_rows(spark, ["x,y,12x"]).withColumn("seq", F.lit(0))
    with pytest.raises(Exception, match="malformed click line"):
        P.parse_click_csv(lines, strict=True).collect()


def test_parse_csv_tolerant_rejects(spark):
    lines = line_rows(spark, ["x,y,12x", "x,y", "ok,u, 5"]).withColumn("seq", F.monotonically_increasing_id())
    good, bad = P.split_rejects(P.parse_click_csv(lines, strict=False))
    assert rows(good, "user", "url", "timestamp") == [("ok", "u", 5)]
    assert bad.count() == 2


def test_words_keep_positions(spark):
    out = P.words(line_rows(spark, ["a  b "]), "value").orderBy("pos").collect()
    assert [(r.pos, r.word) for r in out] == [(0, "a"), (1, ""), (2, "b")]


def test_generator_domain_f9(spark):
    from fixtures import URLS9, USERS9
    from clickflow.operators import windows as W
    from clickflow.operators.ranking import top_n
    data = [(USERS9[i % 6], URLS9[(i * 5) % 6], 1000 * i) for i in range(36)]
    c = from_click_records(click_rows(spark, data))
    parsed = P.parse_click_csv(P.click_csv_lines(c))
    assert rows(parsed, "user", "url", "timestamp") == sorted(data)
    docs = {r.doc for r in json_documents(c).collect()}
    assert '{"小明":"/abc@a=1?"}' in docs
    top = top_n(W.url_counts(c, 10_000, 5_000), 2)
    assert top.count() > 0 and top.filter(F.col("rk") > 2).count() == 0
