"""Tables with awkward rows for the training-data tests."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators might use themselves
    T.StructField("key", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("kept_id", T.LongType())])

WORDS = "the of and with river stone light under morning every window garden silent paper moves across".split()


def sentence(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x % len(WORDS)] + str(x // 64 % 50))
    return " ".join(out)


def awkward_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, shared lines."""
    shared = sentence(1, 60)
    long_text = "\n".join(sentence(100 + i, 40) for i in range(400))
    rows = [
        (1, "first line here\n" + shared + "\nlast of one", "en", "a"),
        (2, "another start\n" + shared + "\nend of two", "en", "a"),
        (3, None, "en", "a"), (4, "", None, "a"), (5, " \t\n ", "de", None),
        (6, long_text, "en", "b"), (6, long_text, "en", "b"), (7, "short", "en", "b"),
        (None, "a text without an id\n" + sentence(9, 30), None, None), (None, None, None, None),
        (8, shared, "en", "a"), (9, "UPPER Case and été 漢字 \U0001f600 <|endoftext|>", "fr", "c"),
        (10, "\n".join(["twice the same short line"] * 30), "en", "c"),
        (11, sentence(5, 200), "en", "a"), (12, sentence(5, 199) + " changed", "en", "a")]
    return spark.createDataFrame([(*r, None, "k", 0.5, 3) for r in rows], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
