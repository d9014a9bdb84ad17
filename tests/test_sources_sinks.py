import os

import pytest
from pyspark.sql import functions as F

from clickflow.operators import transforms as P
from clickflow.operators.udf import flatmap_udtf
from clickflow.session import local_path, scratch_path
from clickflow.sinks import hour_bucket, write_text_files
from clickflow.sources import read_lines, stream_lines
from clickflow.sources.kafka import click_payload, decode_value, encode_records, kafka_stream
from clickflow.sources.rows import click_rows
from clickflow.sources.tables import from_click_records
from clickflow.streaming.runner import run_available_now
from checks import rows
from fixtures import CLICKS3, LINES


def _text_file(spark, lines):
    d = local_path(scratch_path(spark, "test", "text"))
    os.makedirs(d)
    with open(os.path.join(d, "world.txt"), "w") as f:
        f.write("\n".join(lines))
    return d


def _counts(df):
    return P.words(df, "value").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def test_batch_word_count_from_text_file_f3(spark):
    got = dict(rows(_counts(read_lines(spark, _text_file(spark, LINES)))))
    assert got.pop("hello") == 2 and set(got.values()) == {1}
    assert sorted(got) == sorted(["world", "my", "name", "is", "lihua", "how", "are", "you", "java"])


def test_streaming_word_count_from_text_folder(spark):
    d = _text_file(spark, LINES)
    res = run_available_now(_counts(stream_lines(spark, d, 1)), "wc_test", mode="update")
    assert dict(rows(res.last_per_key(["word"]), "word", "n"))["hello"] == 2


def test_udtf_flatmap_matches_expression_form(spark):
    c = from_click_records(click_rows(spark, CLICKS3)).withColumn("seq", F.col("seq").cast("long"))
    got = flatmap_udtf("b")(c.select("seq", "user_id", "url", "ms").asTable())
    assert rows(got, "seq", "pos", "v") == rows(P.flatmap_conditional(c, "b"), "seq", "pos", "v")


def test_kafka_record_round_trip(spark):
    c = from_click_records(click_rows(spark, CLICKS3))
    recs = encode_records(P.click_csv_lines(c), "seq", "value", "seq")
    assert dict(recs.dtypes)["value"] == "binary"
    back = P.parse_click_csv(decode_value(recs, "seq"))
    assert rows(back, "user", "url", "timestamp") == [("a", "./home", 1000), ("b", "./h", 1212), ("c", "./sdf", 1231)]
    payload = click_payload(c.withColumn("user_id", F.col("user_id"))).orderBy("seq").first()
    assert payload.value == '{"user":"a","url":"./home","timestamp":1000}'


def test_kafka_source_needs_connector_jar(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_stream(spark, "localhost:9", "clicks")


def test_bucketed_text_files(spark):
    c = from_click_records(click_rows(spark, [("a", "/x", 0), ("b", "/y", 3_600_000)]))
    out = scratch_path(spark, "test", "files")
    write_text_files(c.select(P.event_text().alias("value"), hour_bucket("ms").alias("bucket")), out,
                     max_records_per_file=1)
    back = spark.read.text(out)
    assert rows(back, "bucket") == [("1970-01-01--00",), ("1970-01-01--01",)]


def test_rich_mapper_lifecycle(spark):
    import pandas as pd
    from clickflow.operators.udf import RichMapper, map_rich

    class Tagged(RichMapper):
        def open(self, partition):
            self.pid, self.opened = partition, True

        def map(self, pdf):
            return pd.DataFrame({"seq": pdf["seq"], "pid": self.pid})

    df = spark.range(0, 1000, numPartitions=4).withColumnRenamed("id", "seq")
    out = map_rich(df, Tagged, "seq long, pid int")
    assert sorted(r.pid for r in out.select("pid").distinct().collect()) == [0, 1, 2, 3]
    assert out.count() == 1000


def test_roll_by_bytes(spark):
    from clickflow.sinks import records_for_bytes
    c = from_click_records(click_rows(spark, [("a", "/x", i) for i in range(100)]))
    lines = c.select(P.event_text().alias("value"), hour_bucket("ms").alias("bucket"))
    n = records_for_bytes(lines, "value", 400)
    out = scratch_path(spark, "test", "roll")
    write_text_files(lines, out, roll_bytes=400)
    files = [f for f in os.listdir(os.path.join(local_path(out), "bucket=1970-01-01--00")) if f.startswith("part-")]
    assert n >= 1 and len(files) >= 100 // n
