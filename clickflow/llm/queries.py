"""The training-data queries (`opN_<name>`), each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import common, op10_winnowed_lines, op11_fim_skiplist, op12_conversation_repair, op13_topk_search, op1_sentencepiece, op2_wrapper_html, op3_golay_simhash, op4_harmonic_packing, op5_mcd_rules, op6_repair_ids, op7_nb_toxicity, op8_rda_quality, op9_graph_neardup


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return op1_sentencepiece.encode(docs, tokenizer_path("piece_bpe_32k.model")).drop("ids")


def op2_wrapper_html_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_wrapper_html.extract(common.table(spark, sf_dir, "pages"))


def op3_golay_simhash_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_golay_simhash.groups(common.table(spark, sf_dir, "documents"))


def op4_harmonic_packing_(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return op4_harmonic_packing.pack(docs, tokenizer_path("word_bpe_49k.json")).drop("ids")


def op5_mcd_rules_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_mcd_rules.rules(common.table(spark, sf_dir, "documents"))


def op6_repair_ids_(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    path = common.shared_path(spark, "repair")
    op6_repair_ids.write(docs, path, tokenizer_path("word_bpe_49k.json"))
    return op6_repair_ids.read(spark, path, with_ids=False)


def op7_nb_toxicity_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_nb_toxicity.classify(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op8_rda_quality_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_rda_quality.classify(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op9_graph_neardup_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_graph_neardup.near_duplicates(common.table(spark, sf_dir, "embeddings"))


def op10_winnowed_lines_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_winnowed_lines.dedup(common.table(spark, sf_dir, "documents"))


def op11_fim_skiplist_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_fim_skiplist.digests(common.table(spark, sf_dir, "documents"))


def op12_conversation_repair_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_conversation_repair.audits(op12_conversation_repair.damage(common.table(spark, sf_dir, "conversations")))


def op13_topk_search_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_topk_search.top5(common.table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece_codec,
    "op2_wrapper_html": op2_wrapper_html_,
    "op3_golay_simhash": op3_golay_simhash_,
    "op4_harmonic_packing": op4_harmonic_packing_,
    "op5_mcd_rules": op5_mcd_rules_,
    "op6_repair_ids": op6_repair_ids_,
    "op7_nb_toxicity": op7_nb_toxicity_,
    "op8_rda_quality": op8_rda_quality_,
    "op9_graph_neardup": op9_graph_neardup_,
    "op10_winnowed_lines": op10_winnowed_lines_,
    "op11_fim_skiplist": op11_fim_skiplist_,
    "op12_conversation_repair": op12_conversation_repair_,
    "op13_topk_search": op13_topk_search_,
}
#: DuckDB SQL by query, where SQL can state the result.
ORACLE_SQL: dict[str, str] = {
    "op11_fim_skiplist": op11_fim_skiplist.SQL,
    "op12_conversation_repair": op12_conversation_repair.SQL,
    "op13_topk_search": op13_topk_search.SQL,
}
