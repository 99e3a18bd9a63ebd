"""CSV files whose quoted fields hold line breaks, read by many tasks per file.

Spark splits text files at line ends, but a line end inside quotes ends no record, and whether a split starts
inside quotes depends on all that stands before it. Each split therefore first tells, for
both cases, in which case it ends: one row per split. Chaining these rows in file order gives the true case
at the start of every split. In a second pass over the lines each split puts its records together; the pieces
of records that cross a split, at most two per split, are joined by the split where they began. Every
record is then parsed by Spark's own CSV parser.

A quote opens a field only right after a delimiter or at the start of a record, a doubled quote
inside quotes is a quote, and text after a closing quote runs up to the next delimiter, as in Spark's parser.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrain.session import materialise

#: Splits that start inside quotes up to which their list (20 bytes each) goes to every task.
BROADCAST_SPLITS = 500_000
QUOTE = '"'


def ends_inside(line: str, inside: bool, delimiter: str = ",") -> bool:
    """Whether a line that starts inside (or outside) quotes ends inside quotes."""
    at, opening = 0, delimiter + QUOTE
    while True:
        if not inside:
            if at == 0 and line.startswith(QUOTE):
                at = 1
            else:
                at = line.find(opening, at - len(delimiter) if at else 0)
                if at < 0:
                    return False
                at += len(opening)
        # Inside: up to a quote that is not doubled, then on to the next delimiter.
        while True:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line.startswith(QUOTE, at + 1):
                at += 2
            else:
                break
        inside, at = False, line.find(delimiter, at + 1)
        if at < 0:
            return False
        at += len(delimiter)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """The splits in a batch of lines, ``(file, start)`` with the rows from and to."""
    file, start = (np.asarray(batch.column(at)) for at in (0, 1))
    if not len(file):
        return
    cuts = [0, *(np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1).tolist(), len(file)]
    for begin, end in zip(cuts, cuts[1:]):
        yield (int(file[begin]), int(start[begin])), begin, end


def _split_table(lines: DataFrame, delimiter: str) -> DataFrame:
    """``file, start`` and, for both cases, whether the split ends inside quotes and still in the record it began in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key: tuple[int, int], state: list[bool]) -> pa.RecordBatch:
            values = [*key, *state]
            return pa.RecordBatch.from_arrays([pa.array([value]) for value in values], ["file", "start", "from_outside", "from_inside", "unclosed"])

        key, state = None, [False, True, True]
        for batch in batches:
            quoted = batch.column(2)
            for at_key, begin, end in _runs(batch):
                if at_key != key:
                    if key is not None:
                        yield row(key, state)
                    key, state = at_key, [False, True, True]
                for line in quoted.slice(begin, end - begin).drop_null().to_pylist():
                    outside, inside, unclosed = state
                    after = ends_inside(line, inside, delimiter)
                    state = [after if outside == inside else ends_inside(line, outside, delimiter), after, unclosed and after]
        if key is not None:
            yield row(key, state)

    quoted = F.when(F.contains("value", F.lit(QUOTE)), F.col("value"))
    return lines.select("file", "start", quoted.alias("quoted")).mapInArrow(
        run, "file long, start long, from_outside boolean, from_inside boolean, unclosed boolean"
    )


def _inside_splits(splits: pd.DataFrame) -> pd.DataFrame:
    """Of one file's splits those that start inside quotes, with the split in which their first record began."""
    inside, owner, rows = False, -1, []
    for row in splits.sort_values("start").itertuples():
        if inside:
            rows.append((row.file, row.start, owner))
            if not row.unclosed:
                owner = row.start
            inside = row.from_inside
        else:
            inside, owner = row.from_outside, row.start
    return pd.DataFrame(rows, columns=["file", "start", "owner"])


def _records(lines: DataFrame, delimiter: str) -> DataFrame:
    """``file, owner, piece, first, record``: whole records (``owner`` null) and pieces of those that cross splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            columns = zip(*rows) if rows else [[]] * 5
            batch = pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["file", "owner", "piece", "first", "record"])
            rows.clear()
            return batch

        def close_split() -> None:
            """What is still open at a split's end goes on in the next one."""
            if held:
                whose = owner if owner is not None else key[1]
                rows.append((key[0], whose, key[1], first, "\n".join(held)))
                held.clear()

        key, held, inside, owner, first = None, [], False, None, False
        for batch in batches:
            owners = batch.column(3)
            for at_key, begin, end in _runs(batch):
                if at_key != key:
                    if key is not None:
                        close_split()
                    key, owner = at_key, owners[begin].as_py()
                    inside, first = owner is not None, at_key[1] == 0
                for line in batch.column(2).slice(begin, end - begin).to_pylist():
                    if inside or QUOTE in line:
                        inside = ends_inside(line, inside, delimiter)
                    if not held and not inside and owner is None:
                        if line and line != "\r":
                            rows.append((key[0], None, None, first, line))
                            first = False
                        continue
                    held.append(line)
                    if not inside:
                        whole = owner is None
                        rows.append((key[0], owner, None if whole else key[1], first, "\n".join(held)))
                        held.clear()
                        owner, first = None, False
            yield flush()
        if key is not None:
            close_split()
            yield flush()

    return lines.select("file", "start", "value", "owner").mapInArrow(
        run, "file long, owner long, piece long, first boolean, record string"
    )


def csv_records(spark: SparkSession, path: str, delimiter: str = ",", header: bool = True) -> DataFrame:
    """``record``: the text of every record of the files under ``path``, without headers and empty lines."""
    scan = spark.read.option("lineSep", "\n").text(path)
    lines = scan.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    # One row per split of the scan; the second pass meets the same splits, as both read the same listing.
    splits = materialise(_split_table(lines, delimiter))
    inside = materialise(splits.groupBy("file").applyInPandas(_inside_splits, "file long, start long, owner long"))
    if inside.count() <= BROADCAST_SPLITS:
        placed = lines.join(F.broadcast(inside), ["file", "start"], "left")
    else:
        # The list is too long to send around: meet it by split and put each split's lines in order again.
        ordered = lines.withColumn("at", F.monotonically_increasing_id()).join(inside, ["file", "start"], "left")
        placed = ordered.repartition("file", "start").sortWithinPartitions("file", "start", "at").drop("at")
    pieces = _records(placed, delimiter)
    whole = pieces.where("owner IS NULL").select("first", "record")
    joined = (
        pieces.where("owner IS NOT NULL")
        .groupBy("file", "owner")
        .agg(F.array_sort(F.collect_list(F.struct("piece", "first", "record"))).alias("pieces"))
        .select(
            F.exists("pieces", lambda piece: piece["first"]).alias("first"),
            F.array_join(F.transform("pieces", lambda piece: piece["record"]), "\n").alias("record"),
        )
    )
    records = whole.unionByName(joined)
    return (records.where("NOT first") if header else records).select("record")


def read_quoted_csv(
    spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str], delimiter: str = ",", header: bool = True
) -> DataFrame:
    """The files under ``path`` as a table; ``options`` are those of Spark's CSV parser."""
    settings = {"sep": delimiter, "quote": QUOTE, "escape": QUOTE, **options}
    # A carriage return before the line feed that ends a record belongs to the line end.
    record = F.regexp_replace("record", "\r\\z", "")
    parsed = csv_records(spark, path, delimiter, header).select(F.from_csv(record, schema.simpleString(), settings).alias("row"))
    return parsed.select("row.*")
