"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source the keys are cut into ranges, the
words of each range are summed, prefix sums over the ranges find the range in which the
source's budget ends, and only that range is sorted row by row. So no task ever sorts a
source, however large; texts are never shuffled, and what is compared with every row is one
line per source: full epochs, the key at which the last epoch is cut, and how many words the
document at the cut still gives. A target above the source's size repeats whole epochs.

Sources in code point order, null last, weigh 1, 2, 3, repeating (or as ``weights`` says). Their
targets share all words in proportion to weight; no target exceeds ``max_epochs`` times its
source's size, what is over goes to the others by weight.

Defined results: null and empty texts have size 0 and are never taken; a null source is a source
of its own; repeated rows are separate documents, of which equal ones share a cut in any order;
a null doc_id sorts first; an empty table gives an empty mix. ``mix`` keeps every column of
the input whatever its name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexigrain.llm.common import WORD_PATTERN, store

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix"
#: Key ranges of each source, a power of two; a range holds so small a share of any source.
RANGE_BITS = 12
KEY_BITS = 60
#: Sources up to which the table of cuts is sent to every task.
MANY_SOURCES = 100_000

_JAVA_WORD = r"[^\x20\x09-\x0D]+"
assert WORD_PATTERN == "[^\x20\x09-\x0d]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_JAVA_WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, seed: str = SEED) -> Column:
    """60 random bits that depend on the id and the seed alone."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def sized(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, key, doc``: what the plan needs of each document."""
    return documents.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        random_key(F.col("doc_id"), seed).alias("key"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"),
    )


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``; a window over one row per source."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(weight) for weight in weights])
    weighted = sources.withColumn("rank", F.row_number().over(everything)).withColumn(
        "weight", F.get(cycle, (F.col("rank") - 1) % len(weights))
    )
    # The sources that reach their cap are those of the lowest cap per weight.
    cap = F.col("source_size") * max_epochs
    by_cap = Window.orderBy(cap / F.col("weight"), "rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    leveled = weighted.withColumn("cap", cap).withColumn("level", left / weight_left)
    free = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.min_by(F.when(free, F.col("level")), F.when(free, F.struct(F.col("cap") / F.col("weight"), F.col("rank")))).over(whole)
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return leveled.select("source", "source_size", target.alias("target"))


def cut_plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: size, target, full epochs, and where the last epoch is cut.

    ``rows`` are ``sized`` documents, stored because they are read twice.
    """
    bucket = F.shiftright("key", KEY_BITS - RANGE_BITS)
    sums = store(
        rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("bucket_size")), "mix-ranges"
    )
    sources = sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1))
    rest = budget % size
    planned = targets(sources, weights, max_epochs).select(
        "*", ((budget - rest) / size).cast("long").alias("epochs"), rest.alias("rest")
    )
    planned = store(planned, "mix-targets")
    in_order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.withColumn("before", F.coalesce(F.sum("bucket_size").over(in_order), F.lit(0)))
    of = planned.select(F.col("source").alias("of"), "rest")
    cut_ranges = (
        ranges.join(of, F.col("source").eqNullSafe(F.col("of")))
        .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("bucket_size")))
        .select("of", F.col("bucket").alias("of_bucket"), "before", "rest")
    )
    # Only the rows of one range of each source are sorted; equal rows count as one group.
    inside = rows.join(
        bounded_broadcast(store(cut_ranges, "mix-cuts")),
        F.col("source").eqNullSafe(F.col("of")) & (bucket == F.col("of_bucket")),
    )
    groups = inside.groupBy("of", "before", "rest", "key", "doc", "size").agg(F.count("*").alias("rows"))
    weight = F.col("size") * F.col("rows")
    running = Window.partitionBy("of").orderBy("key", "doc", "size").rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("rest") - (F.col("before") + F.sum(weight).over(running) - weight)
    cuts = (
        groups.withColumn("left", left)
        .where((F.col("left") >= 0) & (F.col("left") < weight))
        .select(
            "of",
            F.col("key").alias("cut_key"),
            F.col("doc").alias("cut_doc"),
            F.col("size").alias("cut_size"),
            F.floor(F.col("left") / F.col("rows")).cast("long").alias("cut_words"),
        )
    )
    plan = planned.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").drop("of", "rest")
    return store(plan.withColumnRenamed("source", "of"), "mix-plan")


def bounded_broadcast(per_source: DataFrame) -> DataFrame:
    """A stored table of one row per source, sent to every task if its counted rows are few."""
    return F.broadcast(per_source) if per_source.count() <= MANY_SOURCES else per_source


def _taken() -> tuple[Column, Column]:
    """Whole copies of a row, and the words of one more that is cut."""
    key, doc, size = F.col("key"), F.col("doc"), F.col("size")
    cut_key, cut_doc, cut_size = F.col("cut_key"), F.col("cut_doc"), F.col("cut_size")
    same_doc = (key == cut_key) & (doc == cut_doc)
    earlier = (key < cut_key) | ((key == cut_key) & (doc < cut_doc)) | (same_doc & (size < cut_size))
    copies = F.coalesce(F.col("epochs"), F.lit(0)) + F.when(earlier, 1).otherwise(0)
    return copies, F.when(same_doc & (size == cut_size), F.col("cut_words")).otherwise(F.lit(0))


def with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    return rows.join(bounded_broadcast(plan), F.col("source").eqNullSafe(F.col("of")))


def mix_table(documents: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document."""
    rows = store(sized(documents), "mix-sizes")
    plan = cut_plan(rows, weights, max_epochs)
    copies, words = _taken()
    taken = (copies * F.col("size") + words).alias("taken")
    return with_plan(rows, plan).select("doc_id", "size", "source_size", "target", taken)


def first_words(text: Column, count: Column) -> Column:
    """A text up to its ``count``-th word, white space kept."""
    parts = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(parts, F.lit(1), count), "")


def mix(documents: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, whole_texts: bool = False) -> DataFrame:
    """The mixed documents: one row for each copy taken, the one at a cut with its first words only.

    With ``whole_texts`` the one at a cut is taken whole, so a source exceeds its budget by less than that document
    (rows of equal id and size share a cut and are taken together).
    """
    plan = cut_plan(store(sized(documents), "mix-sizes"), weights, max_epochs)
    whole = documents.select(F.struct("*").alias("row"))
    rows = whole.select(
        "row",
        F.col("row.source").alias("source"),
        word_count(F.col("row.text")).alias("size"),
        random_key(F.col("row.doc_id")).alias("key"),
        F.coalesce(F.col("row.doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"),
    )
    copies, words = _taken()
    amounts = F.concat(
        F.array_repeat(F.lit(None).cast("long"), copies.cast("int")), F.when(words > 0, F.array(F.lit(None).cast("long") if whole_texts else words)).otherwise(F.array())
    )
    text = F.when(F.col("words").isNull(), F.col("row.text")).otherwise(first_words(F.col("row.text"), F.col("words").cast("int")))
    taken = with_plan(rows.where("size > 0"), plan).select("row", F.explode(amounts).alias("words"))
    return taken.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in documents.columns])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 15) AS BIGINT) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, (rank - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM sources),
leveled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
one AS (
  SELECT arg_min(level, ROW(cap / weight, rank)) AS level FROM leveled WHERE level * weight <= cap),
targets AS (
  SELECT source, source_size, CAST(least(cap, one.level * weight) AS DOUBLE) AS target,
         CAST(floor(least(cap, one.level * weight) + 0.5) AS BIGINT) AS budget
  FROM leveled, one),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.budget // greatest(t.source_size, 1) AS epochs,
         t.budget % greatest(t.source_size, 1) AS rest,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM placed
"""
