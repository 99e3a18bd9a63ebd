"""A pipeline of training text: classify, apply rules, drop near copies, mix sources, encode.

Every stage works on all that its predecessor kept. ``run`` writes each result as Parquet in the
shared folder and reads it back, so a lost executor costs one stage's tasks at most.

Null and empty texts fail the quality rules; an empty table stays empty through all stages; extra
columns pass through all stages but the last, which returns ids and token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrain.llm import mixing, ngram_join, prefix_bpe, quality_model, quality_rules
from lexigrain.llm.common import store
from lexigrain.llm.queries import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model scores as good; learned from the labels of these documents."""
    model = quality_model.learn(docs, table(spark, sf_dir, "labels"))
    return quality_model.keep_good(docs, model)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the table of quality rules."""
    return quality_rules.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group of similar documents; null ids drop none."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, repeated or left out so that each source has its share of all words; no text is cut."""
    mixed = mixing.mix(docs, whole_texts=True)
    return mixed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else mixed


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids`` of every row of the mix, and whether decoding gives the text's symbols back."""
    return prefix_bpe.round_trip(docs.select("doc_id", "source", "text")).select(
        "doc_id",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("near_copies", drop_near_copies),
    ("source_mix", mix_sources),
    ("bpe", encode),
]

#: The classifier and the encoder are not expressible in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
