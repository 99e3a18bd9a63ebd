"""Per-class n-gram statistics over a clean-text column.

A document lists its distinct n-grams with their counts inside its own row, so the
corpus is shuffled once, by n-gram, after map-side aggregation. Document frequency
needs no distinct aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrain.fixed_values import (
    CONTENT_STOP_WORDS,
    LABELS,
    MIN_DOCUMENTS,
    MIN_STOP_WORD_DOCUMENTS,
    STOP_WORDS,
)
from lexigrain.functions.expressions import (
    bind,
    ngrams,
    run_lengths,
    split_words,
    text_or_empty,
    word_tokens,
)
from lexigrain.session import materialise


def ngram_counts(
    corpus: DataFrame, sizes: Sequence[int] = (1,), min_df: int = MIN_DOCUMENTS, text: str = "clean_text"
) -> DataFrame:
    """``target, n, ngram, frequency, documents`` of n-grams found in enough documents."""
    tokens = word_tokens(text_or_empty(F.col(text)))
    per_size = bind(
        tokens,
        lambda words: F.flatten(
            F.array(
                *[
                    _sized(run_lengths(ngrams(words, n)), n)
                    for n in sizes
                ]
            )
        ),
    )
    exploded = corpus.select("target", F.inline(per_size))
    counted = exploded.groupBy("target", "n", "ngram").agg(
        F.sum("tf").alias("frequency"), F.count(F.lit(1)).alias("documents")
    )
    return counted.where(F.col("documents") >= min_df)


def _sized(runs: Column, n: int) -> Column:
    def entry(run: Column) -> Column:
        return F.struct(F.lit(n).alias("n"), run["term"].alias("ngram"), run["tf"].alias("tf"))

    return F.transform(runs, entry)


def _totals(counts: DataFrame) -> Column:
    """Kept occurrences per (class, size) as literals; one row per class and size is read."""
    sums = counts.groupBy("target", "n").agg(F.sum("frequency").alias("total")).collect()
    total = F.lit(None).cast("long")
    for row in sums:
        here = (F.col("target") == row.target) & (F.col("n") == row.n)
        total = F.when(here, F.lit(row.total)).otherwise(total)
    return total


def ngram_frequencies(
    corpus: DataFrame,
    sizes: Sequence[int] = (1,),
    min_df: int = MIN_DOCUMENTS,
    top_k: int | None = 40,
    labels: Sequence[int] = LABELS,
    text: str = "clean_text",
) -> DataFrame:
    """Frequency and probability of the commonest n-grams of each class.

    The probability refers to all kept n-grams of the class, not to the reported ones.
    The per-class limit is pushed below the shuffle by the optimiser. The counted
    vocabulary is stored, because totals and ranking read it and texts are the dear part.
    """
    labelled = corpus.where(F.col("target").isin(list(labels)))
    counts = materialise(ngram_counts(labelled, sizes, min_df, text))
    table = counts.select(
        "target",
        "n",
        "ngram",
        "frequency",
        (F.col("frequency") / _totals(counts)).alias("probability"),
    )
    if not top_k:
        return table
    order = Window.partitionBy("target", "n").orderBy(F.desc("frequency"), "ngram")
    return table.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top_k).drop("_rank")


def require_vocabulary(table: DataFrame) -> DataFrame:
    """Raise when no n-gram was kept, as an empty vocabulary is an error upstream."""
    if table.isEmpty():
        raise ValueError("empty vocabulary: no n-gram reaches the document threshold")
    return table


def discriminative_terms(
    corpus: DataFrame,
    smoothing: float = 0.5,
    min_total: int = 8,
    min_df: int = MIN_DOCUMENTS,
    text: str = "clean_text",
) -> DataFrame:
    """Smoothed log2 ratio of class 1 to class 0 over the joined vocabulary.

    Pivoting both classes in one aggregation replaces the full outer join of two tables.
    """
    tokens = word_tokens(text_or_empty(F.col(text)))
    exploded = corpus.select("target", F.inline(run_lengths(tokens)))

    def of_class(label: int, value: Column) -> Column:
        return F.sum(F.when(F.col("target") == label, value).otherwise(0))

    pivoted = exploded.groupBy(F.col("term").alias("ngram")).agg(
        of_class(0, F.col("tf")).alias("f0"),
        of_class(1, F.col("tf")).alias("f1"),
        of_class(0, F.lit(1)).alias("d0"),
        of_class(1, F.lit(1)).alias("d1"),
    )
    kept = pivoted.where((F.col("d0") >= min_df) | (F.col("d1") >= min_df)).select(
        "ngram",
        F.when(F.col("d0") >= min_df, F.col("f0")).otherwise(0).alias("freq_0"),
        F.when(F.col("d1") >= min_df, F.col("f1")).otherwise(0).alias("freq_1"),
    )
    kept = materialise(kept)
    sums = kept.agg(
        F.coalesce(F.sum("freq_0"), F.lit(0)).alias("total_0"),
        F.coalesce(F.sum("freq_1"), F.lit(0)).alias("total_1"),
        F.count(F.lit(1)).alias("vocabulary"),
    ).first()

    def share(count: str, total: str) -> Column:
        return (F.col(count) + smoothing) / (sums[total] + smoothing * max(1, sums["vocabulary"]))

    return (
        kept.select(
            "ngram",
            "freq_0",
            "freq_1",
            F.log2(share("freq_1", "total_1") / share("freq_0", "total_0")).alias("log2_ratio"),
            (F.col("freq_0") + F.col("freq_1")).alias("total_frequency"),
        )
        .where(F.col("total_frequency") >= min_total)
        .orderBy(F.desc("log2_ratio"), "ngram")
    )


def stop_word_audit(
    corpus: DataFrame,
    min_documents: int = MIN_STOP_WORD_DOCUMENTS,
    stop_words: Sequence[str] = STOP_WORDS,
    content_words: Sequence[str] = CONTENT_STOP_WORDS,
) -> DataFrame:
    """Per-class document frequency of stop-words among the raw lower-cased tokens.

    Each row sends only the stop-words it holds and, under a null word, how many
    distinct tokens it has; the class totals come out of the same single pass.
    """
    found = bind(
        F.array_distinct(split_words(F.lower(text_or_empty(F.col("text"))))),
        lambda words: F.concat(
            F.transform(
                F.filter(words, lambda word: word.isin(list(stop_words))),
                lambda word: F.struct(word.alias("word"), F.lit(1).alias("n")),
            ),
            F.array(F.struct(F.lit(None).cast("string").alias("word"), F.size(words).alias("n"))),
        ),
    )
    exploded = corpus.select("target", F.inline(found))
    counts = exploded.groupBy("word").agg(
        F.sum(F.when(F.col("target") == 0, F.col("n")).otherwise(0)).alias("documents_0"),
        F.sum(F.when(F.col("target") == 1, F.col("n")).otherwise(0)).alias("documents_1"),
    )
    # One row per stop-word and one with the totals: the list bounds this window.
    whole = Window.partitionBy(F.lit(0))

    def total(count: str) -> Column:
        return F.max(F.when(F.col("word").isNull(), F.col(count))).over(whole)

    def odds(count: str, whole_count: str) -> Column:
        return (F.col(count) + 0.5) / F.greatest(F.lit(1), F.col(whole_count))

    return (
        counts.withColumns({"t0": total("documents_0"), "t1": total("documents_1")})
        .where(F.col("word").isNotNull())
        .where(F.col("documents_0") + F.col("documents_1") >= min_documents)
        .select(
            "word",
            "documents_0",
            "documents_1",
            F.log2(odds("documents_1", "t1") / odds("documents_0", "t0")).alias("log2_ratio"),
            F.col("word").isin(list(content_words)).alias("is_content_word"),
        )
        .orderBy(F.desc("log2_ratio"), "word")
    )


def cloud_weights(corpus: DataFrame, max_words: int = 180, labels: Sequence[int] = LABELS) -> DataFrame:
    """Word-cloud weights: unigram frequency relative to the commonest one of the class."""
    top = ngram_frequencies(corpus, (1,), min_df=1, top_k=max_words, labels=labels)
    peak = F.max("frequency").over(Window.partitionBy("target"))
    return top.select(
        "target", F.col("ngram").alias("word"), "frequency", (F.col("frequency") / peak).alias("weight")
    )
