"""Reading a labelled corpus ``id, keyword, location, text, target``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrain.fixed_values import MISSING_TOKENS
from lexigrain.sources.quoted_csv import read_quoted_csv

CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("target", T.IntegerType()),
    ]
)


def missing_to_null(column: Column) -> Column:
    return F.when(~column.isin(list(MISSING_TOKENS)), column)


def read_corpus_csv(spark: SparkSession, path: str, schema: T.StructType = CORPUS_SCHEMA) -> DataFrame:
    """Quoted CSV, fields may span lines, many tasks per file; the usual missing-value tokens become null."""
    # "" is one of the missing-value tokens, handled below with the others.
    frame = read_quoted_csv(spark, path, schema, {"mode": "FAILFAST", "nullValue": ""})
    strings = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return frame.withColumns({name: missing_to_null(F.col(name)) for name in strings})


#: Session setting: partitions into which a benchmark deals out tables of one or two splits.
INPUT_PARTITIONS = "lexigrain.input.partitions"


def spread(frame: DataFrame, key: str) -> DataFrame:
    """Deal a table out by ``key`` if the session asks for it, as it is else.

    Text work is bound by the processor, and the small files of tests and benchmarks are one
    task. A large table has splits enough, so nothing is set there and nothing is shuffled.
    """
    parts = frame.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return frame.repartition(int(parts), key) if parts else frame


def corpus_from_tables(
    documents: DataFrame, labels: DataFrame | None = None, label: str = "quality"
) -> DataFrame:
    """Corpus from a document table and a label table that share ``doc_id``.

    The join is left to the optimiser: a small label table is broadcast, a large one
    meets the documents hash-partitioned by id.
    """
    corpus = documents.select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("keyword"),
        F.col("lang").alias("location"),
        "text",
    )
    if labels is None:
        return corpus
    wanted = labels.select(F.col("doc_id").alias("id"), F.col(label).alias("target"))
    return corpus.join(wanted, "id")


def unlabelled_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.select(F.col("doc_id").alias("id"))
    return corpus_from_tables(documents).join(known, "id", "left_anti")
