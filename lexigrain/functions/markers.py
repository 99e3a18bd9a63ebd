"""Surface markers, lengths and presence flags, all read from the raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexigrain.fixed_values import NEGATION_WORDS
from lexigrain.functions.cleaning import MENTION, STANDALONE_911, URL
from lexigrain.functions.expressions import (
    NOT_AFTER_WORD,
    NOT_BEFORE_WORD,
    bind,
    count_words,
    run_lengths,
    split_words,
    text_or_empty,
)

#: Decimal digits plus the signs Unicode gives a digit value (superscripts, circled digits, …).
DIGIT = (
    r"[\p{Nd}²³¹\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}"
    r"\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}"
    r"\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}]"
)
NEGATION = f"(?i){NOT_AFTER_WORD}(?:{'|'.join(NEGATION_WORDS)}){NOT_BEFORE_WORD}"

MARKERS = (
    "url_count",
    "mention_count",
    "hashtag_count",
    "exclamation_count",
    "question_count",
    "digit_count",
    "contains_911",
    "emoji_like_count",
)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def surface_markers(text: Column) -> dict[str, Column]:
    """Eight integer columns by name; a missing text counts as an empty one."""
    raw = text_or_empty(text)
    return {
        "url_count": _count(raw, URL),
        "mention_count": _count(raw, MENTION),
        "hashtag_count": _count(raw, "#"),
        "exclamation_count": _count(raw, "!"),
        "question_count": _count(raw, r"\?"),
        "digit_count": _count(raw, DIGIT),
        "contains_911": raw.rlike(STANDALONE_911).cast("int"),
        "emoji_like_count": _count(raw, r"[^\x00-\x7F]"),
    }


def length_features(text: Column, clean_text: Column) -> dict[str, Column]:
    raw = text_or_empty(text)
    return {
        "char_count": F.length(raw),
        "word_count": count_words(raw),
        "clean_word_count": count_words(clean_text),
        "unique_word_ratio": unique_word_ratio(text),
    }


def unique_word_ratio(text: Column) -> Column:
    return bind(
        split_words(F.lower(text_or_empty(text))),
        lambda words: F.size(F.array_distinct(words)) / F.greatest(F.lit(1), F.size(words)),
    )


def presence(column: Column) -> Column:
    return column.isNotNull().cast("int")


def uppercase_percent(text: Column) -> Column:
    raw = text_or_empty(text)
    return 100 * _count(raw, r"\p{IsUppercase}") / F.greatest(F.lit(1), F.length(raw))


def most_repeated_token(text: Column) -> Column:
    """How often the commonest lower-cased token of the row occurs, 0 without tokens."""
    runs = run_lengths(split_words(F.lower(text_or_empty(text))))
    return F.coalesce(F.array_max(F.transform(runs, lambda run: run["tf"])), F.lit(0))


def contains_negation(text: Column) -> Column:
    """Negation flag. ``n't`` must stand alone: inside "don't" it does not count."""
    return text_or_empty(text).rlike(NEGATION).cast("int")


def decode_percent(text: Column) -> Column:
    """Percent-decoding that keeps ``+`` and leaves malformed codes alone."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)
