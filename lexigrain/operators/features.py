"""The feature frame: corpus columns plus everything read off the text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrain.fixed_values import STOP_WORDS
from lexigrain.functions.cleaning import clean_for_classification, clean_for_sentiment
from lexigrain.functions.expressions import reuse
from lexigrain.functions.labelling import negativity_score, sentiment_label
from lexigrain.functions.markers import length_features, presence, surface_markers
from lexigrain.functions.polarity import COUNTS, sentiment_of
from lexigrain.sources.lexicon import Lexicon

FEATURES = (
    "char_count",
    "word_count",
    "clean_word_count",
    "unique_word_ratio",
    "url_count",
    "mention_count",
    "hashtag_count",
    "exclamation_count",
    "question_count",
    "digit_count",
    "contains_911",
    "emoji_like_count",
    "keyword_present",
    "location_present",
)


def add_clean_text(corpus: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    column = reuse(
        ("clean", "text", tuple(stop_words)),
        lambda: clean_for_classification(F.col("text"), stop_words),
    )
    # Never null: see add_sentiment.
    return corpus.withColumn("clean_text", F.coalesce(column, F.lit("")))


def add_features(corpus: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Clean text, lengths, surface markers and presence flags; a narrow projection."""
    return add_clean_text(corpus, stop_words).withColumns(
        {
            **length_features(F.col("text"), F.col("clean_text")),
            **surface_markers(F.col("text")),
            "keyword_present": presence(F.col("keyword")),
            "location_present": presence(F.col("location")),
        }
    )


def add_sentiment(corpus: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Light text, polarity scores, label, negativity and word counts; no shuffle."""
    light = reuse(("light", "text"), lambda: clean_for_sentiment(F.col("text")))
    scored = reuse(
        ("sentiment", "sentiment_text", lexicon),
        lambda: sentiment_of(F.col("sentiment_text"), lexicon),
    )
    passed = corpus.columns
    frame = corpus.withColumn("sentiment_text", light).withColumn("_sentiment", scored)
    def number(path: str, empty: float | int) -> Column:
        # Never null, which keeps null filters from being pushed below this projection,
        # where they would score every text once more.
        return F.coalesce(F.col(f"_sentiment.{path}"), F.lit(empty))

    compound = number("scores.compound", 0.0)
    return frame.select(
        *passed,
        "sentiment_text",
        compound.alias("sentiment_compound"),
        number("scores.negative", 0.0).alias("sentiment_negative"),
        number("scores.positive", 0.0).alias("sentiment_positive"),
        number("scores.neutral", 0.0).alias("sentiment_neutral"),
        sentiment_label(compound).alias("sentiment_label"),
        negativity_score(compound).alias("negativity"),
        *[number(f"counts.{name}", 0).alias(name) for name in COUNTS],
    )
