"""Reports over the feature frame and the sentiment frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrain.fixed_values import (
    CATEGORY_NAMES,
    LABELS,
    NEGATIVE_THRESHOLD,
    POSITIVE_THRESHOLD,
    SENTIMENT_LABELS,
    THRESHOLD_SOURCE,
    TOP_NEGATIVE,
    TOP_POSITIVE,
    WORD_TYPES,
)
from lexigrain.functions.cleaning import STANDALONE_911
from lexigrain.functions.labelling import category, named, right_closed_bin
from lexigrain.functions.markers import (
    contains_negation,
    decode_percent,
    most_repeated_token,
    surface_markers,
    uppercase_percent,
)
from lexigrain.operators.features import FEATURES
from lexigrain.operators.ranking import group_summary, widen
from lexigrain.session import materialise

SENTIMENT_MEASURES = (
    "sentiment_compound",
    "negativity",
    "sentiment_negative",
    "sentiment_positive",
    "sentiment_neutral",
    "pos_word_count",
    "neg_word_count",
    "neu_word_count",
    "token_count",
)
PRESENCE_MARKERS = (
    "url_count",
    "mention_count",
    "hashtag_count",
    "exclamation_count",
    "question_count",
    "contains_911",
    "emoji_like_count",
)
EXTREME_COLUMNS = (
    "id",
    "text",
    "target",
    "category",
    "sentiment_label",
    "sentiment_compound",
    "negativity",
    "pos_word_count",
    "neg_word_count",
)


def percent_of(count: str, *keys: str) -> Column:
    """Share of a count in its group; meant for small aggregated tables."""
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return 100 * F.col(count) / F.sum(count).over(group)


def label_distribution(corpus: DataFrame, names: Mapping[int, str] = CATEGORY_NAMES) -> DataFrame:
    """Rows per label with the share of the whole; unlabelled rows count in the whole only."""
    counts = corpus.groupBy("target").agg(F.count(F.lit(1)).alias("documents"))
    shares = counts.select(
        "target",
        "documents",
        category(F.col("target"), names).alias("category"),
        percent_of("documents").alias("percent"),
    )
    return shares.where(F.col("target").isNotNull()).orderBy("target")


def features_by_class(features: DataFrame, metrics: Sequence[str] = FEATURES) -> DataFrame:
    """Mean, median and standard deviation of every feature per label, one row per label."""
    labelled = features.where(F.col("target").isNotNull())
    stats = group_summary(labelled, ["target"], metrics)
    return widen(stats, ["target"], metrics, ("mean", "median", "std"))


def cleaning_audit(features: DataFrame) -> DataFrame:
    """Ten indicators of what the cleaning did, as ``indicator, value``."""
    indicators = {
        "documents": F.count(F.lit(1)),
        "empty_text": F.count_if(F.col("text") == ""),
        "empty_clean_text": F.count_if(F.col("clean_text") == ""),
        "mean_words": F.avg("word_count"),
        "mean_clean_words": F.avg("clean_word_count"),
        "with_url": F.count_if(F.col("url_count") > 0),
        "with_mention": F.count_if(F.col("mention_count") > 0),
        "with_hashtag": F.count_if(F.col("hashtag_count") > 0),
        "with_911": F.sum("contains_911"),
        "clean_with_911": F.count_if(F.col("clean_text").rlike(STANDALONE_911)),
    }
    row = features.agg(*[value.cast("double").alias(name) for name, value in indicators.items()])
    return row.unpivot([], list(indicators), "indicator", "value")


def before_after_examples(features: DataFrame, with_marker: int = 8, without: int = 4) -> DataFrame:
    """The first rows by id with a marker and the first ones without.

    Both come from one pass over the texts: every task keeps its first rows of either kind before anything
    is shuffled.
    """
    marked = (
        (F.col("url_count") > 0)
        | (F.col("mention_count") > 0)
        | (F.col("hashtag_count") > 0)
        | (F.col("contains_911") == 1)
    )
    kinds = features.select("id", "target", "text", "clean_text", F.coalesce(marked, F.lit(False)).alias("_marked"))
    place = F.row_number().over(Window.partitionBy("_marked").orderBy("id"))
    first = kinds.withColumn("_place", place).where(F.col("_place") <= max(with_marker, without))
    wanted = F.when(F.col("_marked"), with_marker).otherwise(without)
    return first.where(F.col("_place") <= wanted).select("id", "target", "text", "clean_text")


def marker_rates(
    features: DataFrame,
    markers: Sequence[str] = PRESENCE_MARKERS,
    names: Mapping[int, str] = CATEGORY_NAMES,
) -> DataFrame:
    """Share of documents of a class in which a marker occurs."""
    rates = (
        features.where(F.col("target").isNotNull())
        .groupBy("target")
        .agg(*[(100 * F.avg((F.col(m) > 0).cast("double"))).alias(m) for m in markers])
    )
    long = rates.unpivot(["target"], list(markers), "marker", "percent")
    return long.select("marker", "target", "percent", category(F.col("target"), names).alias("category"))


def top_keywords(corpus: DataFrame, k: int = 15) -> DataFrame:
    """Commonest percent-decoded keywords of each class."""
    decoded = corpus.where(F.col("target").isNotNull()).na.drop(subset=["keyword"])
    counts = (
        decoded.groupBy("target", "keyword")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("target", decode_percent(F.col("keyword")).alias("keyword_decoded"))
        .agg(F.sum("n").alias("frequency"))
    )
    order = Window.partitionBy("target").orderBy(F.desc("frequency"), "keyword_decoded")
    return counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


def sentiment_by_class(sentiment: DataFrame, names: Mapping[int, str] = CATEGORY_NAMES) -> DataFrame:
    """Every class with every sentiment, zero-filled, and the share within the class.

    Counting the three labels side by side and unpivoting yields the complete grid, so no
    grid has to be built and joined.
    """
    counted = (
        sentiment.where(F.col("target").isNotNull())
        .groupBy("target")
        .agg(*[F.count_if(F.col("sentiment_label") == name).alias(name) for name in SENTIMENT_LABELS])
    )
    whole = F.expr(" + ".join(SENTIMENT_LABELS))
    long = counted.withColumn("_whole", whole).unpivot(
        ["target", "_whole"], list(SENTIMENT_LABELS), "sentiment_label", "documents"
    )
    return long.select(
        "target",
        "sentiment_label",
        "documents",
        (100 * F.col("documents") / F.col("_whole")).alias("percent"),
        category(F.col("target"), names).alias("category"),
    )


def sentiment_observed(sentiment: DataFrame) -> DataFrame:
    """The same counts without completing the grid."""
    counts = (
        sentiment.where(F.col("target").isNotNull())
        .groupBy("target", "sentiment_label")
        .agg(F.count(F.lit(1)).alias("documents"))
    )
    return counts.withColumn("percent", percent_of("documents", "target"))


def sentiment_global(sentiment: DataFrame) -> DataFrame:
    counts = sentiment.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("documents"))
    return counts.withColumn("percent", percent_of("documents")).orderBy(
        F.desc("documents"), "sentiment_label"
    )


def sentiment_statistics(
    sentiment: DataFrame,
    measures: Sequence[str] = SENTIMENT_MEASURES,
    names: Mapping[int, str] | None = CATEGORY_NAMES,
) -> DataFrame:
    """Count, mean, median and standard deviation of the sentiment measures per class."""
    labelled = sentiment.where(F.col("target").isNotNull())
    stats = group_summary(labelled, ["target"], measures)
    wide = widen(stats, ["target"], measures, ("count", "mean", "median", "std"))
    return wide.withColumn("category", category(F.col("target"), names)) if names else wide


def mean_sentiment_words(
    sentiment: DataFrame, names: Mapping[int, str] = CATEGORY_NAMES
) -> DataFrame:
    """Mean positive, negative and neutral words per class, long form."""
    means = (
        sentiment.where(F.col("target").isNotNull())
        .groupBy("target")
        .agg(*[F.avg(name).alias(name) for name in WORD_TYPES])
    )
    long = means.unpivot(["target"], list(WORD_TYPES), "counted", "mean_words")
    return long.select(
        category(F.col("target"), names).alias("category"),
        named(F.col("counted"), WORD_TYPES).alias("word_type"),
        "mean_words",
    )


def threshold_catalogue(spark: SparkSession) -> DataFrame:
    """The three labelling rules as a table."""
    negative, neutral, positive = SENTIMENT_LABELS
    return spark.createDataFrame(
        [
            (positive, f"compound >= {POSITIVE_THRESHOLD}", THRESHOLD_SOURCE),
            (negative, f"compound <= {NEGATIVE_THRESHOLD}", THRESHOLD_SOURCE),
            (neutral, f"{NEGATIVE_THRESHOLD} < compound < {POSITIVE_THRESHOLD}", THRESHOLD_SOURCE),
        ],
        "label string, rule string, source string",
    )


def tagged_extremes(sentiment: DataFrame, k: int = 10, names: Mapping[int, str] = CATEGORY_NAMES) -> DataFrame:
    """The k most positive and the k most negative documents, ties by id, with the end they belong to."""
    # Both ends read one stored copy of the scores; then the texts are read once for all 2k rows.
    narrow = [name for name in EXTREME_COLUMNS if name not in ("text", "category")]
    scores = materialise(sentiment.select(*narrow, F.xxhash64("text").alias("_text")))
    order = F.col("sentiment_compound")
    highest = scores.orderBy(order.desc(), "id").limit(k).withColumn("extreme", F.lit(TOP_POSITIVE))
    lowest = scores.orderBy(order, "id").limit(k).withColumn("extreme", F.lit(TOP_NEGATIVE))
    # At most 2k rows; an id that repeats is told apart by its text.
    ends = highest.unionByName(lowest)
    texts = sentiment.select("id", F.xxhash64("text").alias("_text"), "text")
    wanted = F.broadcast(ends.select("id", "_text").distinct())
    found = texts.join(wanted, ["id", "_text"], "left_semi").groupBy("id", "_text").agg(F.first("text").alias("text"))
    picked = ends.join(found, ["id", "_text"])
    return picked.select(*[c for c in EXTREME_COLUMNS if c != "category"], "extreme", category(F.col("target"), names).alias("category"))


def extreme_documents(
    sentiment: DataFrame, k: int = 10, names: Mapping[int, str] = CATEGORY_NAMES
) -> tuple[DataFrame, DataFrame]:
    """Both ends as tables of their own, the outermost documents first."""
    tagged = materialise(tagged_extremes(sentiment, k, names))
    order = F.col("sentiment_compound")

    def end(tag: str, *by: Column) -> DataFrame:
        return tagged.where(F.col("extreme") == tag).orderBy(*by, "id").select(*EXTREME_COLUMNS)

    return end(TOP_POSITIVE, order.desc()), end(TOP_NEGATIVE, order)


def extremes_composition(sentiment: DataFrame, k: int = 10) -> DataFrame:
    return (
        tagged_extremes(sentiment, k)
        .groupBy("extreme", "category")
        .agg(F.count(F.lit(1)).alias("documents"))
    )


def extremes_patterns(sentiment: DataFrame, k: int = 10) -> DataFrame:
    """Surface patterns of the extreme documents."""
    text = F.col("text")
    shown = ("url_count", "mention_count", "hashtag_count", "exclamation_count", "question_count")
    markers = surface_markers(text)
    return tagged_extremes(sentiment, k).select(
        "extreme",
        "id",
        "category",
        "sentiment_compound",
        "negativity",
        "pos_word_count",
        "neg_word_count",
        *[markers[name].alias(name) for name in shown],
        uppercase_percent(text).alias("uppercase_pct"),
        most_repeated_token(text).alias("max_token_repeats"),
        contains_negation(text).alias("contains_negation"),
    )


def negativity_ranges(sentiment: DataFrame, names: Mapping[int, str] = CATEGORY_NAMES) -> DataFrame:
    """Documents per negativity bin and class with the share within the class."""
    counts = (
        sentiment.where(F.col("target").isin(list(LABELS)))
        .groupBy(
            right_closed_bin(F.col("negativity")).alias("range"),
            category(F.col("target"), names).alias("category"),
        )
        .agg(F.count(F.lit(1)).alias("documents"))
    )
    return counts.withColumn("percent", percent_of("documents", "category"))
