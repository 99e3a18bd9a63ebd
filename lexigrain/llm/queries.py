"""The numbered queries over the driver's tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lexigrain.llm import (
    chat_windows,
    importance,
    language_model,
    license_scan,
    mixing,
    near_vectors,
    ngram_join,
    prefix_bpe,
    quality_model,
    quality_rules,
    token_counts,
    token_files,
    turn_trie,
)
from lexigrain.llm.common import new_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Python workers import this package; where it is not installed they find it beside the driver's.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def prefix_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_bpe.encode_decode_digests(table(spark, folder, "documents"))


def token_orc_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_file_digests(table(spark, folder, "documents"), new_path(spark, "tokens"))


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_table(table(spark, folder, "documents"))


def rule_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"))


def additive_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return quality_model.score(documents, quality_model.learn(documents, table(spark, folder, "labels")))


def shingle_groups(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, folder, "documents"), percent=90, size=3)


def near_vector_groups(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, folder, "embeddings"))


def trie_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.held_out_scores(table(spark, folder, "documents"), language_model.EVERY)


def license_spans(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


def revised_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.revised_counts(table(spark, folder, "documents"))


def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return turn_trie.rebuilt_trie(table(spark, folder, "conversations"))


def chat_window_digests(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    marks = [(-1, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]
    added = spark.createDataFrame(marks, "conv_id long, turn long, role string, text string")
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(added)
    return chat_windows.window_digests(rows, new_path(spark, "windows"))


def importance_draw(spark: SparkSession, folder: str) -> DataFrame:
    return importance.importance_table(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def registry() -> dict[str, Query]:
    return {
        "op1_token_orc_files": token_orc_files,
        "op2_near_vector_groups": near_vector_groups,
        "op3_source_mix": source_mix,
        "op4_rule_verdicts": rule_verdicts,
        "op5_license_spans": license_spans,
        "op6_additive_quality": additive_quality,
        "op7_revised_token_counts": revised_token_counts,
        "op8_shingle_groups": shingle_groups,
        "op9_prefix_trie_bpe": prefix_trie_bpe,
        "op10_trie_language_model": trie_language_model,
        "op11_conversation_trie": conversation_trie,
        "op12_chat_windows": chat_window_digests,
        "op13_importance_draw": importance_draw,
    }


def oracles() -> dict[str, str]:
    return {
        "op3_source_mix": mixing.ORACLE,
        "op4_rule_verdicts": quality_rules.ORACLE,
        "op11_conversation_trie": turn_trie.ORACLE,
        "op13_importance_draw": importance.ORACLE,
    }
