"""Sentiment lexicon: word valences, emoji descriptions and modifier words.

The full public lexicon is an input (tab-separated ``token, valence, …``; emojis
``character, description``). A short starter list is bundled for trials.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrain.fixed_values import (
    BOOST,
    DAMPENER_PHRASES,
    DAMPENERS,
    IDIOMS,
    INTENSIFIERS,
    SENTIMENT_NEGATORS,
)
from lexigrain.functions.expressions import LookupTable

LEXICON_SCHEMA = T.StructType(
    [T.StructField("token", T.StringType()), T.StructField("valence", T.DoubleType())]
)
EMOJI_SCHEMA = T.StructType(
    [T.StructField("emoji", T.StringType()), T.StructField("description", T.StringType())]
)

# Starter valences between -4 and 4 (fixed values).
STARTER_VALENCES = """
abuse -3.2; accident -2.1; afraid -2.2; agree 1.5; alive 1.6; amazing 2.8; anger -2.7; angry -2.3;
attack -2.1; attacks -1.9; awesome 3.1; awful -2.0; bad -2.5; beautiful 2.9; best 3.2; better 1.9;
bless 1.8; bliss 2.7; bomb -2.2; brave 2.4; calm 1.3; care 2.2; celebrate 2.7; cheer 2.3; cool 1.3;
crash -1.7; crisis -3.1; cry -2.1; cute 2.0; damage -2.2; danger -2.4; dead -3.3; death -2.9;
destroyed -2.2; devastated -3.0; devastating -3.3; die -2.9; died -2.6; disaster -3.1; dying -2.2;
easy 1.9; emergency -1.6; enjoy 2.2; enjoyed 2.3; excellent 2.7; fail -2.5; fear -2.2; fight -1.6;
fine 0.8; fire -1.4; free 2.3; friend 2.2; fun 2.3; funny 1.9; glad 2.0; good 1.9; great 3.1;
happy 2.7; hate -2.7; help 1.7; hero 2.6; hope 1.9; horrible -2.5; hurt -2.4; idiot -2.3; ill -1.8;
interesting 1.7; joy 2.8; kill -3.7; killed -3.5; kind 2.4; kiss 1.8; laughed 2.0; lol 1.8;
lost -1.3; love 3.2; lovely 2.8; loving 2.9; lucky 1.8; mad -2.2; moron -2.2; murder -3.7; nice 1.8;
no -1.2; okay 0.9; pain -2.3; panic -2.3; party 1.7; peace 2.5; perfect 2.7; please 1.3; poor -2.1;
problem -1.7; proud 2.1; rescue 1.1; rescued 1.8; ridiculous -1.5; riot -2.6; sad -2.1; safe 1.9;
save 2.2; scared -1.9; smile 1.5; sorry -0.3; strong 2.3; stupid -2.4; suicide -3.5; survived 2.3;
tears -0.9; terrible -2.1; terrorist -3.7; thank 1.5; thanks 1.9; tragedy -3.4; trouble -1.7;
ugly -2.3; violence -3.1; want 0.3; warm 0.9; warning -1.4; welcome 2.0; win 2.8; wonderful 2.7;
worried -1.2; worst -3.1; worthless -1.9; wreck -1.9; yeah 1.2; :) 2.0; :( -1.9; :d 2.3; <3 1.9
"""

# Starter emoji descriptions (fixed values).
STARTER_EMOJIS = {
    "😀": "grinning face",
    "😂": "face with tears of joy",
    "😊": "smiling face with smiling eyes",
    "😍": "smiling face with heart-eyes",
    "😢": "crying face",
    "😡": "pouting face",
    "😭": "loudly crying face",
    "🎉": "party popper",
    "❤": "red heart",
    "👍": "thumbs up",
    "🔥": "fire",
}


def starter_valences() -> dict[str, float]:
    entries = (entry.split() for entry in STARTER_VALENCES.split(";"))
    return {word: float(value) for word, value in entries}


def boosters() -> dict[str, float]:
    up = {word: BOOST for word in INTENSIFIERS}
    down = {word: -BOOST for word in DAMPENERS + DAMPENER_PHRASES}
    return up | down


#: Words that the rules name themselves.
SIGNAL_WORDS = ("no", "never", "without", "doubt", "least", "so", "this", "kind")


@dataclass(frozen=True, eq=False)
class Lexicon:
    """Dictionaries the sentiment rules look words up in; keys are lower case."""

    valences: Mapping[str, float] = field(default_factory=starter_valences)
    emojis: Mapping[str, str] = field(default_factory=lambda: dict(STARTER_EMOJIS))
    boosters: Mapping[str, float] = field(default_factory=boosters)
    negators: Sequence[str] = SENTIMENT_NEGATORS
    idioms: Mapping[str, float] = field(default_factory=lambda: dict(IDIOMS))

    @cache
    def valence_table(self) -> LookupTable:
        return LookupTable(dict(self.valences), "double")

    @cache
    def booster_table(self) -> LookupTable:
        return LookupTable(dict(self.boosters), "double")

    @cache
    def idiom_table(self) -> LookupTable:
        return LookupTable(dict(self.idioms), "double")

    def phrase_words(self) -> frozenset[str]:
        """The longest word of each phrase, which stands for the whole."""
        phrases = [phrase for phrase in (*self.boosters, *self.idioms) if " " in phrase]
        return frozenset(max(phrase.split(), key=len) for phrase in phrases)

    def signal_words(self) -> frozenset[str]:
        """Words next to which a scored word can change its value; all others leave it as it is."""
        return frozenset({*self.boosters, *self.idioms, *self.negators, *SIGNAL_WORDS, *self.phrase_words()})

    def emoji_valences(self) -> dict[str, float]:
        """Strongest valence among the words of each description."""
        return {
            emoji: max((self.valences.get(w, 0.0) for w in words.split()), key=abs, default=0.0)
            for emoji, words in self.emojis.items()
        }

    @cache
    def emoji_table(self) -> LookupTable:
        return LookupTable(self.emoji_valences(), "double")

    def first_emoji(self) -> str:
        """Smallest emoji; a token that sorts before it cannot be one."""
        return min(self.emojis, default="\U0010ffff")

    def emoji_pattern(self) -> str | None:
        """A cheap test for texts that may hold an emoji: few ranges instead of all signs."""
        points = sorted({ord(emoji) for emoji in self.emojis if len(emoji) == 1})
        if not points:
            return None
        low, high = [p for p in points if p < 0x2000], [p for p in points if p >= 0x2000]
        parts = [re.escape(chr(p)) for p in low] + ([f"{chr(high[0])}-{chr(high[-1])}"] if high else [])
        return f"[{''.join(parts)}]"


def _bounded_rows(frame: DataFrame) -> list:
    """Rows of a dictionary table; refuses to bring an unexpectedly large one to the driver."""
    limit = LookupTable.MAX_ENTRIES
    rows = frame.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a lexicon may hold at most {limit} entries")
    return rows


def read_lexicon(
    spark: SparkSession, lexicon_path: str, emoji_path: str | None = None, **modifiers
) -> Lexicon:
    """Read tab-separated lexicon files; further columns are ignored, later rows win nothing."""

    def table(path: str, schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(path)

    words = table(lexicon_path, LEXICON_SCHEMA).where(F.col("token").isNotNull())
    valences = {row.token: row.valence for row in _bounded_rows(words)}
    emojis: dict[str, str] = {}
    if emoji_path:
        rows = _bounded_rows(table(emoji_path, EMOJI_SCHEMA).where(F.col("emoji").isNotNull()))
        emojis = {row.emoji: row.description for row in rows}
    return Lexicon(valences=valences, emojis=emojis, **modifiers)
