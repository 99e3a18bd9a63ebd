"""License scans: winnowed fingerprints, an inverted index of templates, banded alignment.

Words are lower-cased and stripped of all but letters and digits. Of the hashes of every three
words in a row, winnowing keeps the least of each window of three, so any five words in a row
that a text shares with a template share a fingerprint. The templates' fingerprints form an
inverted index, fingerprint -> (template, place); hits that go forward in text and template make a
chain, and a local alignment in a band that follows the chain gives matched words, coverage and spans.

Every whole text is scanned where Spark put it: no shuffle, and nothing grows with the corpus but
the rows found. The templates go to every task; their size is checked (``MAX_TEMPLATE_BYTES``).

Defined results: null and empty texts have no spans; a template found several times in a text gives
several rows; overlapping spans of one template keep the one with more matched words, the earlier at
a tie; repeated rows give repeated results; an empty table gives an empty table; templates of fewer
than three words raise ValueError. Other columns of the input are not read.
"""

from __future__ import annotations

import re
from bisect import bisect
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrain.llm.common import WORD_PATTERN, Batches, lower_words, mix, small_batches, texts_of

GRAM, WINDOW, BAND = 3, 3, 8
#: A span counts from so many matched words, and if so many of its words match.
LEAST_WORDS, LEAST_SHARE = 5, 0.6
MAX_TEMPLATE_BYTES = 20_000_000

#: Public license notices looked for by default (fixed values).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
}

RESULT = (
    "doc_id long, template string, matched_words long, template_words long, coverage double, "
    "char_start long, char_end long, template_start long, template_end long"
)
word_spans = re.compile(WORD_PATTERN).finditer
_drop = re.compile(rb"[^0-9a-z\x80-\xff]").sub


class TokenHashes(dict):
    """word -> hash of its letters and digits, 0 if it has none."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        plain = _drop(b"", word)
        value = self[word] = (xxhash.xxh64_intdigest(plain) | 1) - (1 << 63) if plain else 0
        return value


TOKEN_HASHES = TokenHashes()


def tokens(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(TOKEN_HASHES.__getitem__, words), dtype=np.int64, count=len(words))


def grams(found: np.ndarray) -> np.ndarray:
    """A hash for every ``GRAM`` tokens in a row."""
    values = found.view(np.uint64)
    with np.errstate(over="ignore"):
        rolled = mix(values[: max(0, len(values) - GRAM + 1)])
        for step in range(1, GRAM):
            rolled = mix(rolled + values[step : step + len(rolled)])
    return rolled


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Places of hashes that are the least of some window."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    size = min(WINDOW, len(hashes))
    least = np.lib.stride_tricks.sliding_window_view(hashes, size).min(axis=1)
    chosen = np.zeros(len(hashes), bool)
    for step in range(size):
        chosen[step : step + len(least)] |= hashes[step : step + len(least)] == least
    return np.flatnonzero(chosen)


@dataclass(frozen=True)
class Index:
    """Fingerprints of all templates, sorted, with template and place of each."""

    names: list[str]
    words: list[list[int]]
    places: list[dict[int, list[int]]]
    keys: np.ndarray
    template: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, templates: dict[str, str]) -> Index:
        if sum(len(text.encode()) for text in templates.values()) > MAX_TEMPLATE_BYTES:
            raise ValueError("the templates are too large to send to every task")
        keys, owners, places, words, spots = [], [], [], [], []
        for at, text in enumerate(templates.values()):
            found = tokens(lower_words(text))
            found = found[found != 0]
            if len(found) < GRAM:
                raise ValueError(f"a template needs {GRAM} words: {text!r}")
            hashes = grams(found)
            chosen = winnowed(hashes)
            keys.append(hashes[chosen])
            owners.append(np.full(len(chosen), at))
            places.append(chosen)
            words.append(found.tolist())
            spots.append({})
            for spot, word in enumerate(words[-1]):
                spots[-1].setdefault(word, []).append(spot)
        joined = np.concatenate(keys)
        order = np.argsort(joined, kind="stable")
        return cls(list(templates), words, spots, joined[order], np.concatenate(owners)[order], np.concatenate(places)[order])

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of ``hashes``, template and place of every equal fingerprint."""
        low, high = np.searchsorted(self.keys, hashes, "left"), np.searchsorted(self.keys, hashes, "right")
        row = np.repeat(np.arange(len(hashes)), high - low)
        entry = np.arange(len(row)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + np.repeat(low, high - low)
        return row, self.template[entry], self.place[entry]


def chains(place: list[int], at: list[int], length: int):
    """Hits of one template, in the order of ``at`` and ``place``, as chains that go forward in both.

    A step may leave the diagonal by ``BAND``, so a chain follows any number of small edits. A place
    that recurs further on in the text cannot follow itself, so every repetition has its own chain.
    """
    best, before, low = [], [], 0
    for k in range(len(at)):
        while at[k] - at[low] > length + BAND:
            low += 1
        top, source = float(GRAM), -1
        for l in range(k - 1, low - 1, -1):
            down, along = place[k] - place[l], at[k] - at[l]
            turn = abs(along - down)
            if down <= 0 or along <= 0 or turn > BAND or (turn and min(down, along) < GRAM):
                continue
            value = best[l] + min(GRAM, down) - turn / 4
            if value > top:
                top, source = value, l
        best.append(top)
        before.append(source)
    used = bytearray(len(at))
    for k in sorted(range(len(at)), key=lambda k: -best[k]):
        chain = []
        while k >= 0 and not used[k]:
            used[k] = 1
            chain.append(k)
            k = before[k]
        if chain:
            yield chain[::-1]


def cost(a: tuple[int, int], b: tuple[int, int]) -> int:
    """Differences and gaps between two matches that follow each other."""
    return max(b[0] - a[0], b[1] - a[1]) - 1


def between(first: tuple[int, int] | None, last: tuple[int, int] | None, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The matches, of ``pairs`` in text order, that best fill what lies between two; one of the two may be open."""
    score, before = [], []
    for k, pair in enumerate(pairs):
        top, source = (1 - cost(first, pair) if first else 1), -1
        for l in range(k):
            if pairs[l][0] < pair[0] and pairs[l][1] < pair[1]:
                value = score[l] + 1 - cost(pairs[l], pair)
                if value > top:
                    top, source = value, l
        score.append(top)
        before.append(source)
    top, k = (-cost(first, last) if first and last else 0), -1
    for l, pair in enumerate(pairs):
        value = score[l] - cost(pair, last) if last else score[l]
        if value > top:
            top, k = value, l
    found = []
    while k >= 0:
        found.append(pairs[k])
        k = before[k]
    return found[::-1]


def aligned(text: list[int], template: list[int], places: dict[int, list[int]], anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``(text, template)`` places of the matches of an alignment through all anchors.

    Between anchors and beyond the ends it stays in a band around their diagonals. ``places`` are those of
    each word of the template.
    """

    def inside(j0: int, j1: int, i0: int, i1: int, low: int, high: int) -> list[tuple[int, int]]:
        return [
            (j, i) for j in range(max(0, j0), min(len(text), j1)) for i in places.get(text[j], ())
            if i0 <= i < i1 and low - BAND <= j - i <= high + BAND
        ]

    j, i = anchors[0]
    pairs = between(None, (j, i), inside(j - i - BAND, j, 0, i, j - i, j - i))
    for j, i in anchors:
        if pairs and j > pairs[-1][0] + 1:
            last = pairs[-1]
            ends = sorted((last[0] - last[1], j - i))
            pairs += between(last, (j, i), inside(last[0] + 1, j, last[1] + 1, i, *ends))
        pairs += [(j + step, i + step) for step in range(GRAM) if not pairs or j + step > pairs[-1][0]]
    j, i = pairs[-1]
    return pairs + between((j, i), None, inside(j + 1, j - i + len(template) + BAND, i + 1, len(template), j - i, j - i))


def fits(pairs: list[tuple[int, int]]):
    """Runs of matches that count as spans: matched words, text start and end, template start and end.

    Matches count 1, differences and gaps -1; the best run comes first, then what it leaves on either side.
    A run in which too few words match is taken apart at its widest gap.
    """
    left = [(0, len(pairs))]
    while left:
        low, high = left.pop()
        if high - low < LEAST_WORDS:
            continue
        score, begin, top = 0, low, (0, low, low)
        for k in range(low, high):
            if k > begin:
                score -= cost(pairs[k - 1], pairs[k])
            if score <= 0:
                score, begin = 0, k
            score += 1
            if score > top[0]:
                top = (score, begin, k + 1)
        _, start, end = top
        left += [(low, start), (end, high)]
        if end - start < LEAST_WORDS:
            continue
        (j0, i0), (j1, i1) = pairs[start], pairs[end - 1]
        if end - start >= LEAST_SHARE * max(j1 + 1 - j0, i1 + 1 - i0):
            yield end - start, j0, j1 + 1, i0, i1 + 1
        else:
            cut = max(range(start + 1, end), key=lambda k: cost(pairs[k - 1], pairs[k]))
            left += [(start, cut), (cut, end)]


def spans(found: np.ndarray, index: Index, template: np.ndarray, place: np.ndarray, at: np.ndarray) -> list[tuple]:
    """Rows ``(template, matched, text start, end, template start, end)`` in words, for the hits of one text."""
    words, rows = found.tolist(), []
    order = np.lexsort((place, at, template))
    owners, starts = np.unique(template[order], return_index=True)
    for owner, of in zip(owners.tolist(), np.split(order, starts[1:])):
        i, j, places = place[of].tolist(), at[of].tolist(), index.places[owner]
        results = set()
        for chain in chains(i, j, len(index.words[owner])):
            results.update(fits(aligned(words, index.words[owner], places, [(j[k], i[k]) for k in chain])))
        begins: list[int] = []
        ends: list[int] = []
        for fit in sorted(results, key=lambda fit: (-fit[0], fit[1])):
            spot = bisect(begins, fit[1])  # spans taken so far lie apart and in order
            if (not spot or ends[spot - 1] <= fit[1]) and (spot == len(begins) or fit[2] <= begins[spot]):
                begins.insert(spot, fit[1])
                ends.insert(spot, fit[2])
                rows.append((owner, *fit))
    return sorted(rows, key=lambda row: (row[2], row[0]))


def scan(documents: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """A row for every template span found in every whole text."""
    index = Index.of(templates)

    def run(batches: Batches) -> Batches:
        for batch in small_batches(batches):
            texts = texts_of(batch)
            split = [lower_words(text) for text in texts]
            lengths = np.array([len(words) for words in split], dtype=np.int64)
            every = tokens(list(chain.from_iterable(split)))
            owner = np.repeat(np.arange(len(texts)), lengths)
            solid = np.flatnonzero(every != 0)
            found, owner = every[solid], owner[solid]
            hashes = grams(found)
            inside = owner[: len(hashes)] == owner[GRAM - 1 : GRAM - 1 + len(hashes)]
            chosen = winnowed(np.where(inside, hashes, np.uint64(0xFFFFFFFFFFFFFFFF)))
            chosen = chosen[inside[chosen]]
            row, template, place = index.hits(hashes[chosen])
            at = chosen[row]
            starts = np.searchsorted(owner, np.arange(len(texts) + 1))
            word_start = np.concatenate([[0], np.cumsum(lengths)])
            ids, rows = batch.column(0).to_pylist(), []
            for doc in np.unique(owner[at]).tolist():
                of = owner[at] == doc
                a, b = starts[doc], starts[doc + 1]
                fits = spans(found[a:b], index, template[of], place[of], at[of] - a)
                if not fits:
                    continue
                places = [(m.start(), m.end()) for m in word_spans(texts[doc])]
                real = solid[a:b] - word_start[doc]
                for t, matched, j0, j1, i0, i1 in fits:
                    size = len(index.words[t])
                    rows.append((ids[doc], index.names[t], matched, size, matched / size, places[real[j0]][0], places[real[j1 - 1]][1], i0, i1))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column) for column in zip(*rows)],
                    ["doc_id", "template", "matched_words", "template_words", "coverage", "char_start", "char_end", "template_start", "template_end"],
                )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RESULT)

