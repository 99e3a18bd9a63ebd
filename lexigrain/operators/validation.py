"""Checks and profiles of a corpus table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrain.fixed_values import CORPUS_COLUMNS, LABELS


def corpus_checks(corpus: DataFrame, labels: Sequence[int] = LABELS) -> DataFrame:
    """``check, violations`` from one aggregate pass; all zero means the corpus is sound."""
    seen = {value: F.count_if(F.col("target") == value) for value in labels}
    foreign = F.count_if(F.col("target").isNotNull() & ~F.col("target").isin(list(labels)))
    absent = reduce(lambda a, b: a + b, [(n == 0).cast("long") for n in seen.values()])
    # NULL is one more value here, as in a table of ids where it repeats.
    distinct_ids = F.count_distinct("id") + F.max(F.col("id").isNull().cast("long"))
    checks = corpus.agg(
        F.coalesce(F.count(F.lit(1)) - distinct_ids, F.lit(0)).alias("duplicate_ids"),
        foreign.alias("unknown_labels"),
        absent.alias("missing_labels"),
        F.count_if(F.col("text").isNull()).alias("null_texts"),
    )
    return checks.unpivot([], checks.columns, "check", "violations")


def validate_corpus(corpus: DataFrame, labels: Sequence[int] = LABELS) -> None:
    """Raise ``ValueError`` unless the corpus has the columns, ids, labels and texts it needs."""
    lacking = [name for name in CORPUS_COLUMNS if name not in corpus.columns]
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    broken = [row for row in corpus_checks(corpus, labels).collect() if row.violations]
    if broken:
        raise ValueError("invalid corpus: " + ", ".join(f"{r.check}={r.violations}" for r in broken))


def _compact(field: T.StructField) -> Column:
    """Stand-in for a value in distinct counts: long texts travel as 16-byte digests."""
    column = F.col(field.name)
    return F.unhex(F.md5(column)) if isinstance(field.dataType, T.StringType) else column


def duplicate_rows(frame: DataFrame) -> DataFrame:
    """Rows, columns and rows equal to another row on every column (nulls are equal)."""
    keys = [_compact(field).alias(f"k{i}") for i, field in enumerate(frame.schema.fields)]
    groups = frame.select(*keys).groupBy(*[f"k{i}" for i in range(len(keys))]).count()
    return groups.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("row_count"),
        F.lit(len(keys)).alias("column_count"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def _column_stats(frame: DataFrame) -> DataFrame:
    """``column, rows, nulls, distinct`` with exact distinct counts, ``column`` being the place in the schema.

    A row sends one short (column, digest) pair per value instead of a copy of itself per column; pairs
    that repeat are combined before the shuffle.
    """
    digests = [
        F.struct(F.lit(at).alias("column"), F.xxhash64(F.lit(1), name).alias("a"), F.xxhash64(F.lit(2), name).alias("b"), F.col(name).isNull().alias("missing"))
        for at, name in enumerate(frame.columns)
    ]
    pairs = frame.select(F.inline(F.array(*digests))).groupBy("column", "a", "b", "missing").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("missing"), F.col("n")).otherwise(0)).alias("nulls"),
        F.count_if(~F.col("missing")).alias("distinct"),
    )


def _as_profile(stats: DataFrame, schema: T.StructType) -> DataFrame:
    """The profile table from ``column, rows, nulls, distinct``; a column that no row has counts zero."""
    names = F.array(*[F.struct(F.lit(at).alias("column"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type")) for at, f in enumerate(schema.fields)])
    # One row per column on both sides.
    gathered = stats.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("rows", "nulls", "distinct")))).alias("_stats"))
    rows = gathered.select("_stats", F.inline(names)).withColumn("_of", F.try_element_at("_stats", F.col("column")))
    nulls = F.coalesce("_of.nulls", F.lit(0))
    return rows.select(
        "column_name",
        "data_type",
        nulls.alias("null_count"),
        (100 * nulls / F.greatest(F.coalesce("_of.rows", F.lit(0)), F.lit(1))).alias("null_pct"),
        F.coalesce("_of.distinct", F.lit(0)).alias("distinct_count"),
    )


def schema_profile(frame: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, missing values and distinct values of every column.

    ``approximate`` counts distinct values with mergeable sketches and shuffles one row per task;
    the exact count goes through one pass of (column, digest) pairs.
    """
    stats = united_profile(column_sketches(frame)) if approximate else _column_stats(frame)
    return _as_profile(stats, frame.schema)


#: Binary logarithm of a distinct sketch's registers: about one per cent of error in 16 KB at most.
SKETCH_BITS = 14


def column_sketches(frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by…, column, rows, nulls, sketch``: what any profile of these rows needs, mergeable with those of others."""
    each = [
        F.struct(
            F.lit(at).alias("column"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(name).isNull()).alias("nulls"),
            F.hll_sketch_agg(F.when(F.col(name).isNotNull(), F.xxhash64(name)), SKETCH_BITS).alias("sketch"),
        )
        for at, name in enumerate(frame.columns)
        if name not in by
    ]
    aggregates = [entry.alias(f"_{at}") for at, entry in enumerate(each)]
    packed = frame.groupBy(*by).agg(*aggregates)
    return packed.select(*by, F.inline(F.array(*[f"_{at}" for at in range(len(each))])))


def united_profile(sketches: DataFrame) -> DataFrame:
    """``column, rows, nulls, distinct`` of all rows behind the sketches."""
    return sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias("distinct"),
    )


def update_profile(frame: DataFrame, store: str) -> DataFrame:
    """Profile of a growing table of files from sketches kept under ``store``, one set per file.

    Only files that the store does not hold yet, by path and time of change, are read. ``frame`` must be read from
    files; the profile covers those it lists now, so a removed or rewritten file no longer counts.
    """
    spark = frame.sparkSession
    columns = frame.columns
    identity = {"_path": "file_path", "_changed": "file_modification_time"}
    files = frame.select(*columns, *[F.col(f"_metadata.{field}").alias(name) for name, field in identity.items()])
    known_schema = "_path string, _changed timestamp, column int, rows long, nulls long, sketch binary"
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    known = spark.read.schema(known_schema).parquet(store) if exists else spark.createDataFrame([], known_schema)
    done = known.select("_path", "_changed").distinct()
    listed = files.select("_path", "_changed").distinct()
    # One row per file on either side; the condition on the file's name leaves no column to read of known files.
    new = [row._path for row in listed.join(done, ["_path", "_changed"], "left_anti").collect()]
    if new:
        fresh = files.where(F.col("_path").isin(new))
        column_sketches(fresh, list(identity)).write.mode("append").parquet(store)
        known = spark.read.schema(known_schema).parquet(store)
    current = known.join(listed, ["_path", "_changed"], "left_semi")
    # A file whose sketches were written twice, by a run that was repeated, counts once.
    once = current.dropDuplicates(["_path", "_changed", "column"])
    return _as_profile(united_profile(once), frame.schema)


def null_rates(frame: DataFrame) -> DataFrame:
    """Share of missing values per column, largest first."""
    rates = frame.agg(
        *[(100 * F.avg(F.col(name).isNull().cast("double"))).alias(name) for name in frame.columns]
    )
    long = rates.unpivot([], frame.columns, "column_name", "null_pct")
    return long.orderBy(F.desc("null_pct"), "column_name")
