"""The two text cleanings. The order of the steps decides the result."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexigrain.fixed_values import (
    CONTRACTIONS,
    EMERGENCY_NUMBER,
    EMERGENCY_WORD,
    PUNCTUATION,
    STOP_WORDS,
)
from lexigrain.functions.entities import unescape_html
from lexigrain.functions.expressions import (
    NOT_AFTER_WORD,
    NOT_BEFORE_WORD,
    NOT_SPACE,
    WORD,
    bind,
    has_non_ascii,
    plain_spaces,
    split_words,
    text_or_empty,
)

URL = rf"(?i)(?:https?://|www\.)[{NOT_SPACE}]+"
MENTION = rf"@[{WORD}]+"
STANDALONE_911 = f"{NOT_AFTER_WORD}{EMERGENCY_NUMBER}{NOT_BEFORE_WORD}"
NUMBER = r"\p{Nd}+"
NON_ASCII = r"[^\x00-\x7F]+"


def _contraction_pattern(short: str) -> str:
    whole_word = not short.startswith(("'", "n'"))
    body = short.replace("'", "['’]")
    ends = NOT_BEFORE_WORD
    return f"(?i){NOT_AFTER_WORD if whole_word else ''}{body}{ends}"


def expand_contractions(text: Column) -> Column:
    """Write out English contractions, with the straight and the curly apostrophe."""

    may_be_short = _contains("'", "’")

    def expanded(word: Column) -> Column:
        out = word
        for short, long in CONTRACTIONS:
            out = F.regexp_replace(out, _contraction_pattern(short), long)
        return out

    def by_word(raw: Column) -> Column:
        # No contraction holds a space or looks beyond one, so only words with an apostrophe meet the patterns.
        return F.array_join(
            F.transform(F.split(raw, " "), lambda word: F.when(may_be_short(word), expanded(word)).otherwise(word)), " "
        )

    return _where(may_be_short, text, by_word)


def _where(condition: Callable[[Column], Column], text: Column, change: Callable[[Column], Column]) -> Column:
    """Run a regular expression only on texts a byte search cannot rule out."""
    return bind(text, lambda raw: F.when(condition(raw), change(raw)).otherwise(raw))


def _contains(*needles: str) -> Callable[[Column], Column]:
    def test(text: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in needles])

    return test


def remove_urls(text: Column) -> Column:
    def may_hold_url(raw: Column) -> Column:
        return F.contains(raw, F.lit("://")) | F.contains(F.lower(raw), F.lit("www."))

    return _where(may_hold_url, text, lambda raw: F.regexp_replace(raw, URL, " "))


def remove_mentions(text: Column) -> Column:
    return _where(_contains("@"), text, lambda raw: F.regexp_replace(raw, MENTION, " "))


def protect_emergency_number(text: Column) -> Column:
    """Turn a standalone 911 into a word and other digit runs into a space."""
    kept = _where(
        _contains(EMERGENCY_NUMBER),
        text,
        lambda raw: F.regexp_replace(raw, STANDALONE_911, f" {EMERGENCY_WORD} "),
    )
    return F.regexp_replace(kept, NUMBER, " ")


def delete_punctuation_and_non_ascii(text: Column) -> Column:
    """Both go without leaving a gap; ASCII white space becomes plain on the way.

    Other white space is no ASCII and is deleted like any other such character.
    """
    ascii_only = _where(has_non_ascii, text, lambda raw: F.regexp_replace(raw, NON_ASCII, ""))
    return plain_spaces(ascii_only, deleted=PUNCTUATION)


def drop_stop_words(tokens: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda token: ~token.isin(list(stop_words)))


def classification_tokens(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Tokens of the classification cleaning, stop-words gone, negations and 911 kept."""
    lowered = F.lower(unescape_html(text_or_empty(text)))
    plain = remove_mentions(remove_urls(expand_contractions(lowered)))
    plain = F.replace(plain, F.lit("#"), F.lit(" "))
    plain = delete_punctuation_and_non_ascii(protect_emergency_number(plain))
    tokens = drop_stop_words(F.filter(F.split(plain, " "), lambda token: token != ""), stop_words)
    return F.transform(
        tokens,
        lambda token: F.when(token == EMERGENCY_WORD, F.lit(EMERGENCY_NUMBER)).otherwise(token),
    )


def clean_for_classification(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.array_join(classification_tokens(text, stop_words), " ")


def clean_for_sentiment(text: Column) -> Column:
    """Light cleaning: case, punctuation and emoji stay because they carry polarity."""
    plain = expand_contractions(unescape_html(text_or_empty(text)))
    plain = remove_mentions(remove_urls(plain))
    plain = F.replace(plain, F.lit("#"), F.lit(""))
    spaced = _where(_contains("  "), plain_spaces(plain), lambda raw: F.regexp_replace(raw, " +", " "))
    return F.trim(spaced)
