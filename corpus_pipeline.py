"""Corpus pipeline: quality rules, toxicity, line dedup, SimHash near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
to the shared folder and read again as the next stage's docs.  All but the last return the
columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickflow.llm import common, op10_winnowed_lines, op3_golay_simhash, op4_harmonic_packing, op5_mcd_rules, op7_nb_toxicity
from clickflow.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust distances reject go."""
    common.prepare(spark)
    return op5_mcd_rules.keep_rows(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return op7_nb_toxicity.keep_rows(docs, common.table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut out of the texts."""
    common.prepare(spark)
    return op10_winnowed_lines.keep_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    common.prepare(spark)
    return op3_golay_simhash.keep_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    common.prepare(spark)
    return op4_harmonic_packing.pack(docs, tokenizer_path("word_bpe_49k.json")).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules), ("toxicity", toxicity), ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup), ("packing", packing)]

#: SQL can't state the classifier, the robust estimates or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
