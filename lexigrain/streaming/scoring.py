"""Scoring an unbounded source of texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexigrain.plans.model_store import TextClassifier
from lexigrain.sources.lexicon import Lexicon


def read_text_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int = 100
) -> DataFrame:
    return (
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)
    )


def score_stream(
    stream: DataFrame,
    classifier: TextClassifier,
    output: str,
    checkpoint: str,
    lexicon: Lexicon | None = None,
    fmt: str = "parquet",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score every row once and append it to ``output``.

    Scoring is a projection without state, so the stream needs neither a watermark nor
    micro-batch code, and gives what the batch call gives on the same rows. The
    checkpoint and the file sink make it exactly-once across failures.
    """
    scored = classifier.score(stream, lexicon)
    return (
        scored.writeStream.format(fmt)
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def write_batch(batch: DataFrame, output: str, batch_id: int) -> None:
    """Write a micro-batch to a folder of its own; a batch that is replayed replaces what it wrote before."""
    batch.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")


def score_in_batches(
    stream: DataFrame,
    classifier: TextClassifier,
    output: str,
    checkpoint: str,
    lexicon: Lexicon | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Score all that the stream holds now, batch by batch, into folders keyed by batch id.

    ``prepare`` may do to a batch what a stream cannot, such as an anti join with a table. Every
    batch is written once, also when it is replayed after a failure.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch(classifier.score(prepare(batch), lexicon), output, batch_id)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_batches(spark: SparkSession, output: str, schema: T.StructType) -> DataFrame:
    """Everything the batches have written."""
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(whole).parquet(output).drop("batch")
