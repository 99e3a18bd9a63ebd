"""Small building blocks for column expressions.

Everything here returns a ``Column`` made of built-in functions, so a whole
cleaning or scoring rule stays one narrow JVM-side projection: no shuffle, no
Python worker.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Everything but Unicode white space, written out so that it means the same in every
#: engine; the commonest ranges stand first because a regex tries them in this order.
NOT_SPACE = (
    r"\x{21}-\x{84}\x{a1}-\x{167f}\x{86}-\x{9f}\x{1681}-\x{1fff}\x{200b}-\x{2027}"
    r"\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}\x{0}-\x{8}\x{e}-\x{1b}"
)
#: The same white space as single characters, plain space first.
SPACE_CHARACTERS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(
    map(chr, [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
#: Word characters of any script; the ASCII ones are tried first.
WORD = r"\w\p{L}\p{N}"
NOT_AFTER_WORD = rf"(?<![{WORD}])"
NOT_BEFORE_WORD = rf"(?![{WORD}])"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``let x = value in body(x)``: ``value`` is computed once per row.

    A lambda variable, unlike a column of an inner projection, cannot be inlined
    again by the optimiser, so array lookups inside ``body`` stay cheap.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def plain_spaces(text: Column, deleted: str = "") -> Column:
    """Every white-space character as a plain space, the given characters deleted."""
    return F.translate(text, SPACE_CHARACTERS + deleted, " " * len(SPACE_CHARACTERS))


def split_words(text: Column) -> Column:
    """White-space tokens without empty ones. One mapping pass and a split at a single
    character are several times faster than a split at a regular expression."""
    return F.filter(F.split(plain_spaces(text), " "), lambda word: word != "")


def has_non_ascii(text: Column) -> Column:
    return F.octet_length(text) != F.length(text)


def count_words(text: Column) -> Column:
    """As many words as ``split_words`` gives; no expression of a pattern or per word."""
    return F.size(F.array_remove(F.split(plain_spaces(text), " "), ""))


def run_lengths(items: Column) -> Column:
    """Distinct items of an array with their counts: ``array<struct<term, tf>>``.

    Sorting once and reading off run lengths needs no shuffle, unlike grouping
    exploded items by row, and is linear after the sort.
    """

    def counted(ordered: Column) -> Column:
        starts = F.filter(
            F.transform(
                ordered,
                lambda item, at: F.when((at == 0) | (item != F.get(ordered, at - 1)), at),
            ),
            lambda at: at.isNotNull(),
        )
        return bind(
            starts,
            lambda begin: F.transform(
                begin,
                lambda at, rank: F.struct(
                    F.get(ordered, at).alias("term"),
                    (F.coalesce(F.get(begin, rank + 1), F.size(ordered)) - at).alias("tf"),
                ),
            ),
        )

    return bind(F.sort_array(items), counted)


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined runs of ``n`` neighbouring tokens."""
    if n == 1:
        return tokens
    return bind(
        tokens,
        lambda words: F.transform(
            F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0))),
            lambda word, at: F.concat_ws(" ", word, *[F.get(words, at + k) for k in range(1, n)]),
        ),
    )


def ngram_range(tokens: Column, sizes: Sequence[int]) -> Column:
    return bind(tokens, lambda words: F.concat(*[ngrams(words, n) for n in sizes]))


def word_tokens(text: Column) -> Column:
    """Runs of at least two word characters."""
    return F.regexp_extract_all(text, F.lit(f"[{WORD}]{{2,}}"), F.lit(0))


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


class LookupTable:
    """A dictionary of known, checked size as a hashed literal inside the plan.

    Spark looks map literals up one entry after the other. Spreading the entries
    over ``crc32(key) mod buckets`` makes a lookup take constant time, and since the
    table travels with the task no join, explode or regrouping is needed.
    """

    MAX_ENTRIES = 1_000_000

    def __init__(self, entries: Mapping[str, object], value_type: str) -> None:
        if len(entries) > self.MAX_ENTRIES:
            raise ValueError(f"{len(entries)} entries are too many for a dictionary literal")
        self.size = len(entries)
        self.buckets = 1 << max(0, (max(1, len(entries)) - 1).bit_length())
        self.value_type = value_type
        spread: list[dict[str, object]] = [{} for _ in range(self.buckets)]
        for key, value in entries.items():
            spread[zlib.crc32(key.encode("utf-8")) % self.buckets][key] = value
        self._json = json.dumps(spread, ensure_ascii=False)

    def __call__(self, key: Column) -> Column:
        if not self.size:
            return F.lit(None).cast(self.value_type)
        table = F.from_json(F.lit(self._json), f"array<map<string,{self.value_type}>>")
        slot = (F.crc32(key) % F.lit(self.buckets)).cast("int")
        return F.try_element_at(F.get(table, slot), key)


def literal_array(values: Sequence[float], value_type: str = "double") -> Column:
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{value_type}>")


_BUILT: dict[tuple, Column] = {}


def reuse(key: tuple, build: Callable[[], Column]) -> Column:
    """Keep a long expression for the running application: building it takes thousands of
    calls into the JVM, while the finished column can stand in any number of plans."""
    context = SparkContext._active_spark_context
    if context is None:
        return build()
    full_key = (context.applicationId, *key)
    if full_key not in _BUILT:
        _BUILT[full_key] = build()
    return _BUILT[full_key]
