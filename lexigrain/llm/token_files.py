"""Token ids in ORC files.

A corpus of token ids is a folder of ORC files in ascending document order, one row per
document: ``doc_id, part, start_in_part, n_tokens, ids``. Ids are integers, so ORC run-length
encodes them; every 10,000 rows have index entries, ``doc_id`` has Bloom filters, and stripes
are the unit of parallel reads. A filter on ``doc_id`` skips files and stripes by their
statistics and row groups by index and Bloom filter, without touching the ids.

The write is one range shuffle of the texts by document id; encoding happens after it, so only
texts move and each task encodes and writes one range. Ranges are cut by row samples of the id and of the
beginning of the text, so neither a hot source nor a hot or null id is one task's work. ``start`` (ids of all documents before)
is the start within the file, taken while writing, plus the totals of the files before: a sum
over one row per file.

Defined results: null text counts as empty, a document without tokens still has the end id;
repeated ids are separate rows, ordered among themselves by text; a null doc_id comes first;
an empty table gives an empty folder that reads as an empty table. Other columns of the
input, whatever their names, are not stored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexigrain.llm.common import Batches, flat_list, list_array, small_batches, split_words, texts_of
from lexigrain.llm.pieces import TOKENIZER_FILE, library_encoder, packed, tokenizer_path

ROW_SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"
#: Documents of the query contract end in this id.
END_ID = 1


def write_tokens(
    documents: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER_FILE,
    end_id: int = END_ID,
    stripe_bytes: int = 16 << 20,
    bloom_rate: float = 0.01,
) -> None:
    """Encode whole texts, append ``end_id`` and write ORC files in ascending ``doc_id`` order."""
    model = tokenizer_path(tokenizer)
    end = packed([end_id])

    def run(batches: Batches) -> Batches:
        encoder = library_encoder(model)
        part, before = TaskContext.get().partitionId(), 0
        for batch in small_batches(batches):
            encoded = [encoder.encode(split_words(text)) + end for text in texts_of(batch)]
            counts = np.array([len(part) // 4 for part in encoded], dtype=np.int64)
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            ids = list_array(np.frombuffer(b"".join(encoded), dtype="<i4"), counts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(counts), part, dtype=np.int32)), pa.array(starts), pa.array(counts), ids],
                ["doc_id", "part", "start_in_part", "n_tokens", "ids"],
            )

    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # Rows of one id, null among them, are cut into ranges by how their texts begin.
    ordered = rows.repartitionByRange(F.col("doc_id"), F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    options = {
        "compression": "zstd",
        "orc.stripe.size": str(stripe_bytes),
        "orc.row.index.stride": "10000",
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": str(bloom_rate),
    }
    ordered.mapInArrow(run, ROW_SCHEMA).write.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; a filter on ``doc_id`` reaches the stripes' metadata."""
    return spark.read.schema(ROW_SCHEMA).orc(path)


def part_starts(rows: DataFrame) -> DataFrame:
    """``part, part_start``: the ids of all files before each; sums over one row per file."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    return totals.select("part", F.coalesce(F.sum("part_tokens").over(earlier), F.lit(0)).alias("part_start"))


def with_starts(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``rows`` of the ``stored`` corpus with ``start``, the number of ids of all documents before."""
    start = F.col("start_in_part") + F.col("part_start")
    return rows.join(part_starts(stored), "part").withColumn("start", start)


def digests(rows: DataFrame) -> DataFrame:
    """Per document ``doc_id, part, start_in_part``, number and crc32 of the ids, from the ids themselves."""

    def run(batches: Batches) -> Batches:
        for batch in small_batches(batches, column="ids"):
            flat, offsets = flat_list(batch.column(batch.schema.get_field_index("ids")))
            data = memoryview(np.ascontiguousarray(flat, dtype="<u4")).cast("B")
            bounds = (4 * offsets).tolist()
            sums = [zlib.crc32(data[start:end]) for start, end in zip(bounds, bounds[1:])]
            names = ("doc_id", "part", "start_in_part")
            columns = [batch.column(batch.schema.get_field_index(name)) for name in names]
            counts = np.diff(offsets).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts), pa.array(sums, pa.int64())], [*names, "n_tokens", "ids_crc32"]
            )

    return rows.mapInArrow(run, "doc_id long, part int, start_in_part long, n_tokens long, ids_crc32 long")


def token_file_digests(documents: DataFrame, path: str) -> DataFrame:
    """Write the corpus to ``path``, read it back, and return place, size and checksum of each document."""
    write_tokens(documents, path)
    rows = read_tokens(documents.sparkSession, path)
    return with_starts(digests(rows), rows).select("doc_id", "start", "n_tokens", "ids_crc32")
