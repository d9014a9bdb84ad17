"""Text sources (S1 bounded scan, S2 streaming scan) and the line view of
``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``readTextFile``: one row per line, column ``value``.  A line ends at a line
    feed; one carriage return before it belongs to the end, other ones to the line."""
    return _ended(spark.read.option("lineSep", "\n").text(path))


def _ended(lines: DataFrame) -> DataFrame:
    cut = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return lines.withColumn("value", cut)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming text scan of a folder (new files become new micro-batches)."""
    r = spark.readStream.format("text").option("lineSep", "\n")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _ended(r.load(path))


def document_lines(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """documents -> (doc_id, line_no, line): each text split on newlines,
    whole texts, positions 0-based; columns to keep come in between."""
    return documents.select(
        "doc_id", *keep, F.posexplode(F.split(F.col("text"), "\n")).alias("line_no", "line"))
