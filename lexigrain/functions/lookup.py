"""Words looked up in the sentiment lexicon, a batch of texts at a time.

Most words of a text are in no dictionary, and an expression that visits every word is
interpreted word by word. Here each distinct word is judged once and remembered; of a text
only the scored words and the neighbours that rules look at go back into Spark, where the
rules are applied.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexigrain.fixed_values import PUNCTUATION
from lexigrain.sources.lexicon import Lexicon

#: Words before and after a scored word that its rules look at.
BEFORE, AFTER = 3, 2
#: What a word is: scored by the rules, written in capitals, counted as positive or negative, "but",
#: a word that can change the value of a scored one, the longest word of a phrase that can.
SCORED, CAPITALS, POSITIVE, NEGATIVE, BUT, SIGNAL, PHRASE = 1, 2, 4, 8, 16, 32, 64
#: Distinct words a task remembers.
WORDS_KEPT = 100_000

FOUND_TYPE = (
    "struct<tokens:array<string>,lower:array<string>,valence:array<double>,touched:array<boolean>,"
    "phrased:array<boolean>,mixed_caps:boolean,token_total:int,own_total:int,up:int,down:int,exclamations:int,questions:int>"
)
FOUND_FIELDS = [
    pa.field("tokens", pa.list_(pa.string())),
    pa.field("lower", pa.list_(pa.string())),
    pa.field("valence", pa.list_(pa.float64())),
    *[pa.field(name, pa.list_(pa.bool_())) for name in ("touched", "phrased")],
    pa.field("mixed_caps", pa.bool_()),
    *[pa.field(name, pa.int32()) for name in ("token_total", "own_total", "up", "down", "exclamations", "questions")],
]


def bare(word: str) -> str:
    """A word without edge punctuation unless at most two characters would stay."""
    core = word.strip(PUNCTUATION)
    return word if len(core) <= 2 else core


class WordFlags(dict):
    """word -> its flags, for words as they stand in a text."""

    def __init__(self, lexicon: Lexicon) -> None:
        super().__init__()
        self.valences = {word: value for word, value in lexicon.valences.items() if value is not None}
        self.signals, self.phrase_words = lexicon.signal_words(), lexicon.phrase_words()
        self.emoji_valences, self.first_emoji = lexicon.emoji_valences(), lexicon.first_emoji()
        # Most words consist of small letters; of these all but the dictionaries' own have no flag.
        self.known = {word: self.judged(word) for word in {*self.valences, *self.signals, *self.emoji_valences, "but"}}

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        flags = self[word] = self.judged(word)
        return flags

    def judged(self, word: str) -> int:
        token = bare(word)
        lower = token.lower()
        own = self.valences.get(lower)
        # Counted is an emoji first, then the word itself, then the word without any edge punctuation.
        value = self.emoji_valences.get(token) if token >= self.first_emoji else None
        if value is None:
            value = own if own is not None else self.valences.get(lower.strip(PUNCTUATION), 0.0)
        flags = POSITIVE if value > 0 else NEGATIVE if value < 0 else 0
        if own is not None:
            flags |= SCORED
        if token != lower and token.upper() == token:
            flags |= CAPITALS
        if lower == "but":
            flags |= BUT
        if lower in self.signals or "n't" in lower:
            flags |= SIGNAL
        if lower in self.phrase_words:
            flags |= PHRASE
        return flags

    def of(self, words: Sequence[str]) -> np.ndarray:
        known = self.known.get
        flags = [known(word, 0) if word.isalpha() and word.islower() else self[word] for word in words]
        return np.array(flags, dtype=np.uint8)


class TextReader:
    """Reads batches of texts: the words around scored ones, and the numbers the scores need."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.flags, self.emojis = WordFlags(lexicon), dict(lexicon.emojis)
        pattern = lexicon.emoji_pattern()
        self.has_emoji = re.compile(pattern).search if pattern else lambda text: None
        self.spell = re.compile(pattern).sub if pattern else None

    def spelled(self, text: str) -> str:
        """Text with each emoji written as its description, set off from what stands before."""
        known = self.emojis
        return self.spell(lambda sign: f" {known[sign[0]]}" if known.get(sign[0]) is not None else sign[0], text)

    def read(self, column: pa.Array) -> pa.Array:
        texts = [text or "" for text in column.to_pylist()]
        words: list[str] = []
        bounds = np.zeros(len(texts) + 1, dtype=np.int64)
        own = np.zeros((len(texts), 3), dtype=np.int64)
        replaced = []
        for at, text in enumerate(texts):
            if self.has_emoji(text):
                # Counted are the words of the text as it is, scored those with emojis spelled out.
                flags = self.flags.of(text.split())
                own[at] = len(flags), np.count_nonzero(flags & POSITIVE), np.count_nonzero(flags & NEGATIVE)
                replaced.append(at)
                words.extend(self.spelled(text).split())
            else:
                words.extend(text.split())
            bounds[at + 1] = len(words)
        flags = self.flags.of(words)
        total = np.diff(bounds)
        plain = np.setdiff1d(np.arange(len(texts)), replaced)
        counts = np.column_stack([total, _per_text(flags & POSITIVE > 0, bounds), _per_text(flags & NEGATIVE > 0, bounds)])
        own[plain] = counts[plain]

        scored = flags & SCORED > 0
        # A word more, through a neighbouring text, does no harm.
        touched, phrased = (scored & _spread(flags & kind > 0, AFTER, BEFORE) for kind in (SIGNAL, PHRASE))
        kept = np.flatnonzero(scored | _spread(touched, BEFORE, AFTER) | _first(flags & BUT > 0, bounds))
        offsets = pa.array(np.searchsorted(kept, bounds), pa.int32())
        tokens = [bare(words[at]) for at in kept.tolist()]
        lower = [token.lower() for token in tokens]
        lists = [
            pa.array(tokens, pa.string()),
            pa.array(lower, pa.string()),
            pa.array(list(map(self.flags.valences.get, lower)), pa.float64()),
            pa.array(touched[kept]),
            pa.array(phrased[kept]),
        ]
        capitals = _per_text(flags & CAPITALS > 0, bounds)
        marks = [[text.count(mark) for text in texts] for mark in "!?"]
        return pa.StructArray.from_arrays(
            [
                *[pa.ListArray.from_arrays(offsets, values) for values in lists],
                pa.array((capitals > 0) & (capitals < total)),
                *[pa.array(numbers, pa.int32()) for numbers in (total, *own.T, *marks)],
            ],
            fields=FOUND_FIELDS,
            mask=pa.array(column.is_null()),
        )


def _spread(marked: np.ndarray, before: int, after: int) -> np.ndarray:
    """Marked words, and so many before and after each."""
    near = marked.copy()
    for distance in range(1, before + 1):
        near[:-distance] |= marked[distance:]
    for distance in range(1, after + 1):
        near[distance:] |= marked[:-distance]
    return near


def _first(marked: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of the marked words only the first of each text."""
    at = np.flatnonzero(marked)
    _, first = np.unique(np.searchsorted(bounds, at, side="right"), return_index=True)
    out = np.zeros(len(marked), dtype=bool)
    out[at[first]] = True
    return out


def _per_text(marked: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(marked, dtype=np.int64)])[bounds])


def name_package() -> None:
    """Python workers import this package; where it is not installed they find it beside the driver's."""
    context = SparkContext._active_spark_context
    if context is not None:
        context.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def found_words(text: Column, lexicon: Lexicon) -> Column:
    """Struct of the words around scored ones, in order, and the numbers of a text the scores need.

    The lists hold every scored word, whether a word near it can change its value (``touched``) or may belong to a phrase
    that can (``phrased``), if so also the ``BEFORE`` words before and the ``AFTER`` words after it, and the first "but", emojis spelled out. What is
    left out is out of reach of all rules, so they give for these words what they give for the whole text.
    Null stays null.
    """
    name_package()
    readers: list[TextReader] = []

    def found(column: pa.Array) -> pa.Array:
        if not readers:  # once in a task
            readers.append(TextReader(lexicon))
        return readers[0].read(column)

    return F.arrow_udf(found, FOUND_TYPE)(text)
