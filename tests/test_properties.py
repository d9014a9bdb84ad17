"""Property checks of the string semantics against small Python models."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickflow.functions.strings import java_split, java_trim


def java_split_model(s: str, sep: str) -> list[str]:
    """String.split with a literal separator and limit 0."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_trim_model(s: str) -> str:
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 0x20:
        i += 1
    while j > i and ord(s[j - 1]) <= 0x20:
        j -= 1
    return s[i:j]


ALPHABET = st.sampled_from(list("ab ,\t\n") + ["\x00", "é", "小"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=12), min_size=50, max_size=200), st.sampled_from([" ", ",", ", "]))
def test_java_split_matches_model(spark, strings, sep):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    got = {r.i: r.a for r in df.select("i", java_split(F.col("s"), sep).alias("a")).collect()}
    for i, s in enumerate(strings):
        assert got[i] == java_split_model(s, sep), (s, sep)


def test_java_trim_matches_model(spark):
    rnd = random.Random(11)
    chars = list("ab \t\n\x00\x1f\x20\x7fé")
    strings = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 8))) for _ in range(300)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", java_trim(F.col("s")).alias("t")).collect()}
    assert all(got[i] == java_trim_model(s) for i, s in enumerate(strings))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "hot", "hot", "hot", None]), st.integers(-20, 20)),
                min_size=1, max_size=120),
       st.integers(1, 40))
def test_prefix_scan_property(spark, data, width):
    from pyspark.sql import Window
    from clickflow.operators.scan import block_of, prefix_scan
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(data)], "seq long, k string, v long")
    specs = {"s": ("sum", F.col("v")), "mx": ("max", F.col("v")), "f": ("first", F.col("v"))}
    got = {r.seq: (r.s, r.mx, r.f) for r in prefix_scan(df, ["k"], ["seq"], block_of("seq", width), specs).collect()}
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    exp = {r.seq: (r.s, r.mx, r.f) for r in df.select(
        "seq", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("mx"), F.first("v").over(w).alias("f")).collect()}
    assert got == exp
