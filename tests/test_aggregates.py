import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickflow.operators import aggregates as A
from clickflow.operators.scan import block_of, expanded_scan, prefix_scan
from clickflow.sources.rows import click_rows
from clickflow.sources.tables import from_click_records
from checks import rows
from fixtures import CLICKS7


@pytest.fixture()
def c7(spark):
    return from_click_records(click_rows(spark, CLICKS7)).withColumn("value", F.col("ms").cast("double"))


@pytest.mark.parametrize("blk", [1, 2, 1 << 16])
def test_running_max_keeps_first_fields(spark, c7, blk):
    out = A.max_keep_first_running(c7, field="ms", block=block_of("seq", blk)).orderBy("seq").collect()
    assert [(r.user_id, r.url, r.ms) for r in out] == [
        ("a", "./home", 1000), ("b", "./h", 1212), ("c", "./sdf", 1231), ("b", "./h", 2002),
        ("c", "./sdf", 3213), ("b", "./h", 2222), ("b", "./h", 3212)]


@pytest.mark.parametrize("blk", [1, 3, 1 << 16])
def test_running_maxby_whole_record(spark, c7, blk):
    out = A.max_by_record_running(c7, field="ms", block=block_of("seq", blk)).orderBy("seq").collect()
    assert [(r.user_id, r.url) for r in out] == [
        ("a", "./home"), ("b", "./h"), ("c", "./sdf"), ("b", "./ada?id=1"), ("c", "./sdf"),
        ("b", "./ada?id=2"), ("b", "./ada?id=3")]


def test_maxby_tie_first_wins(spark):
    c = from_click_records(click_rows(spark, [("u", "first", 5), ("u", "second", 5)])).withColumn(
        "value", F.col("ms").cast("double"))
    assert A.max_by_record(c, field="ms").first().url == "first"


def test_user_frequency_and_most_active(spark, c7):
    assert rows(A.count_by_key(c7)) == [("a", 1), ("b", 4), ("c", 2)]
    assert rows(A.most_active(c7)) == [("b", 4)]


@pytest.mark.parametrize("blk", [1, 2, 1 << 16])
def test_most_active_running(spark, c7, blk):
    out = A.most_active_running(c7, block=block_of("seq", blk)).orderBy("seq").collect()
    assert [(r.user_id, r.cnt) for r in out] == [("a", 1), ("b", 1), ("c", 1), ("b", 2), ("c", 2), ("b", 3), ("b", 4)]


def test_most_active_tie_newer_wins(spark):
    c = from_click_records(click_rows(spark, [("x", "u", 1), ("y", "u", 2)]))
    assert rows(A.most_active(c)) == [("y", 1)]


def test_latest_url_per_user(spark, c7):
    assert rows(A.latest_per_key(c7)) == [("a", "./home"), ("b", "./ada?id=3"), ("c", "./sdf")]


@pytest.mark.parametrize("blk", [1, 13, 97, 10_000])
def test_prefix_scan_matches_single_window(spark, blk):
    """Blocked scan == one window per key, on a skewed key set with nulls."""
    rnd = random.Random(7)
    data = [(i, rnd.choice(["hot"] * 6 + ["k1", "k2", None]), rnd.randint(-50, 50)) for i in range(400)]
    df = spark.createDataFrame(data, "seq long, k string, v long")
    specs = {"s": ("sum", F.col("v")), "mx": ("max", F.col("v")), "mn": ("min", F.col("v")),
             "f": ("first", F.col("v"))}
    got = rows(prefix_scan(df, ["k"], ["seq"], block_of("seq", blk), specs), "seq", "s", "mx", "mn", "f")
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    exp = rows(df.select("seq", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("mx"),
                         F.min("v").over(w).alias("mn"), F.first("v").over(w).alias("f")),
               "seq", "s", "mx", "mn", "f")
    assert got == exp


def test_prefix_scan_global(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("seq"), (F.col("id") % 7).alias("v"))
    got = rows(prefix_scan(df, [], ["seq"], block_of("seq", 64), {"s": ("sum", F.col("v"))}), "seq", "s")
    run, exp = 0, []
    for i in range(1000):
        run += i % 7
        exp.append((i, run))
    assert got == exp


def test_prefix_scan_keeps_rows_with_null_order(spark):
    df = spark.createDataFrame([(None, "k"), (None, "k"), (5, "k"), (9, None)], "seq long, k string")
    out = prefix_scan(df, ["k"], ["seq"], block_of("seq", 4), {"n": ("sum", F.lit(1).cast("long"))})
    got = {(r.k, r.seq): r.n for r in out.collect() if r.seq is not None}
    assert out.count() == 4
    assert got == {("k", 5): 3, (None, 9): 1}


@pytest.mark.parametrize("blk", [1, 7, 64, 10_000])
def test_running_best_matches_a_walk(spark, blk):
    """The one-pass arg-max against a plain walk, with a hot key, null keys and ties."""
    from clickflow.operators.scan import running_best

    rnd = random.Random(11)
    data = [(3 * i, rnd.choice([1] * 4 + [2, 3, 4, None])) for i in range(300)]
    counts, best, exp = {}, None, []
    for seq, k in data:
        counts[k] = counts.get(k, 0) + 1
        best = max([b for b in (best, (counts[k], seq, k)) if b], key=lambda b: b[:2])
        exp.append((seq, best[2], best[0]))
    df = spark.createDataFrame(data, "seq long, k long")
    got = [tuple(r) for r in running_best(df, "k", block_of("seq", blk)).orderBy("seq").collect()]
    assert got == exp


def test_prefix_scan_first_keeps_a_null_first_value(spark):
    df = spark.createDataFrame([(i, "k", None if i < 3 else str(i)) for i in range(9)], "seq long, k string, v string")
    got = rows(prefix_scan(df, ["k"], ["seq"], block_of("seq", 2), {"f": ("first", F.col("v"))}), "seq", "f")
    assert got == [(i, None) for i in range(9)]


@pytest.mark.parametrize("blk", [1, 4, 1000])
def test_expanded_scan_matches_single_window(spark, blk):
    """Running counts of words over documents with null, equal and negative ids, null and empty texts."""
    rnd = random.Random(blk)
    docs = [(rnd.choice([None, *range(-5, 30)]), " ".join(rnd.choice(["a", "b", "", "cc"]) for _ in range(rnd.randint(0, 30)))) for _ in range(60)]
    df = spark.createDataFrame([*docs, (3, None), (4, "")], "id long, text string")

    def expand(d):
        return d.select(*[c for c in ("id", "_blk") if c in d.columns], F.posexplode(F.split("text", " ")).alias("pos", "w"))

    got = expanded_scan(df, expand, ["w"], ["id", "pos"], block_of("id", blk), {"n": ("sum", F.lit(1).cast("long"))})
    so_far = Window.partitionBy("w").orderBy("id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = expand(df).withColumn("n", F.count(F.lit(1)).over(so_far))
    assert rows(got.fillna(-99, "id"), "id", "pos", "w", "n") == rows(want.fillna(-99, "id"), "id", "pos", "w", "n")
