"""Word n-grams of texts, counted or weighted in Arrow batches.

An expression over every word of a text is interpreted word by word. Here the texts of a batch are cut at
once, distinct words and n-grams are numbered, and the numbers are counted as arrays; strings are made only of
distinct n-grams. Batches are taken a few MiB of text at a time, so memory does not depend on their length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrain.functions.expressions import bind, has_non_ascii, text_or_empty, word_tokens
from lexigrain.functions.lookup import name_package

#: Text that is cut at once, in bytes; a longer text stays whole.
CHUNK_BYTES = 4 << 20
#: Fewest bytes of a word. A word beyond ASCII has met the pattern for words already.
LEAST_BYTES = 2
#: Byte -> itself, or a space for ASCII that is no letter, digit or underscore.
WORD_BYTES = np.array([b if b >= 128 or chr(b).isalnum() or b == ord("_") else ord(" ") for b in range(256)], dtype=np.uint8)

WEIGHT_FIELDS = [pa.field("i", pa.int32()), pa.field("w", pa.float64())]
WEIGHTS_TYPE = "array<struct<i:int,w:double>>"
COUNTS_TYPE = "term string, tf long, documents long"


def separable(text: Column) -> Column:
    """Lower-case text whose words (as ``word_tokens`` finds them) the bytes alone tell apart: beyond ASCII only the words."""
    return bind(
        F.lower(text_or_empty(text)),
        lambda raw: F.when(has_non_ascii(raw), F.array_join(word_tokens(raw), " ")).otherwise(raw),
    )


def chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about ``CHUNK_BYTES``, and at least one text, in order."""
    texts = texts.cast(pa.large_string())
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    place = (np.cumsum(sizes) - sizes) // CHUNK_BYTES
    bounds = [*np.flatnonzero(np.diff(place, prepend=-1)).tolist(), len(texts)]
    for start, end in zip(bounds, bounds[1:]):
        yield texts.slice(start, end - start)


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a chunk; for each word in order its number among them, and the text it stands in."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", dtype=np.uint8)[at[0] : at[-1]]
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at - at[0]), pa.py_buffer(WORD_BYTES[raw]))
    parts = pc.split_pattern(plain, " ")
    words, of = parts.flatten(), pc.list_parent_indices(parts)
    kept = pc.greater_equal(pc.binary_length(words), LEAST_BYTES)
    coded = words.filter(kept).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), of.filter(kept).to_numpy()


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers; of millions a sort is several times faster than the hash table of ``np.unique``."""
    ordered = np.sort(numbers)
    return ordered[np.diff(ordered, prepend=-1) > 0]


def _followed(at: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Which places begin ``n`` words of one text, among places that begin one word less."""
    last = np.minimum(at + n - 1, len(of) - 1)
    return (at + n - 1 < len(of)) & (of[at] == of[last])


def count_terms(texts: pa.Array, sizes: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """``term, tf, documents`` of the n-grams of a chunk, each n-gram once."""
    words, ids, of = cut(texts)
    grams, number, at = words, ids, np.arange(len(ids))
    for n in range(1, max(sizes) + 1):
        if n > 1:
            on = _followed(at, of, n)
            at = at[on]
            pairs, number = np.unique(number[on] * len(words) + ids[at + n - 1], return_inverse=True)
            before, last = grams.take(pa.array(pairs // len(words))), words.take(pa.array(pairs % len(words)))
            grams = pc.binary_join_element_wise(before, last, pa.scalar(" ", pa.large_string()))
        if n in sizes and len(grams):
            once = _distinct(of[at] * len(grams) + number) % len(grams)
            counts = [np.bincount(seen, minlength=len(grams)) for seen in (number, once)]
            yield pa.RecordBatch.from_arrays([grams.cast(pa.string()), *map(pa.array, counts)], ["term", "tf", "documents"])


def term_counts(texts: DataFrame, text: str, sizes: Sequence[int]) -> DataFrame:
    """Partial ``term, tf, documents``, several rows to a term; rows of the null term count all texts."""
    name_package()
    sizes = tuple(sizes)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array([batch.num_rows])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), rows, rows], ["term", "tf", "documents"])
            for chunk in chunks(batch.column(0)):
                yield from count_terms(chunk, sizes)

    return texts.select(separable(F.col(text)).alias("text")).mapInArrow(counted, COUNTS_TYPE)


class TermIndex:
    """Known terms as paths of word numbers, one sorted array of steps per length."""

    def __init__(self, terms: Sequence[str], idf: Sequence[float], sizes: Sequence[int]) -> None:
        self.size, self.idf = len(terms), np.array(idf, dtype=np.float64)
        paths = [term.split(" ") for term in terms]
        names = sorted({word for path in paths for word in path})
        numbers = {word: at for at, word in enumerate(names)}
        self.words = pa.array(names, pa.large_string())
        #: By length: the steps (number of the path before, and word), and the term that ends there or -1.
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []
        lengths, before = np.array([len(path) for path in paths]), np.zeros(len(paths), dtype=np.int64)
        for n in range(1, max(sizes) + 1):
            long = np.flatnonzero(lengths >= n)
            last = np.array([numbers[paths[at][n - 1]] for at in long.tolist()], dtype=np.int64)
            keys, before[long] = np.unique(before[long] * len(names) + last, return_inverse=True)
            ends = np.full(len(keys), -1)
            if n in sizes:
                exact = np.flatnonzero(lengths == n)
                ends[before[exact]] = exact
            self.steps.append((keys, ends))

    def found(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term and how often, by text and term, of the known terms in a chunk."""
        distinct, ids, of = cut(texts)
        known = pc.fill_null(pc.index_in(distinct, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        ids = known.astype(np.int64)[ids]
        at, path, hits = np.arange(len(ids)), np.zeros(len(ids), dtype=np.int64), []
        for n, (keys, ends) in enumerate(self.steps, 1):
            on = _followed(at, of, n)
            at, path = at[on], path[on]
            step = ids[at + n - 1]
            wanted = path * len(self.words) + step
            place = np.searchsorted(keys, wanted)
            on = (step >= 0) & (place < len(keys))
            on[on] = keys[place[on]] == wanted[on]
            at, path = at[on], place[on]
            ended = ends[path]
            hits.append((of[at] * self.size + ended)[ended >= 0])
        pairs, times = np.unique(np.concatenate(hits), return_counts=True)
        return pairs // self.size, pairs % self.size, times

    def weights(self, texts: pa.Array) -> pa.Array:
        """For each text of a chunk its normalised weights, in the order of terms."""
        text, term, times = self.found(texts)
        raw = (1 + np.log(times)) * self.idf[term]
        norm = np.sqrt(np.bincount(text, raw * raw, minlength=len(texts)))
        entries = pa.StructArray.from_arrays([pa.array(term, pa.int32()), pa.array(raw / norm[text])], fields=WEIGHT_FIELDS)
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32()), entries)


def term_weights(text: Column, terms: Sequence[str], idf: Sequence[float], sizes: Sequence[int]) -> Column:
    """Array of (term number, weight) of a text, scaled to length one; empty for null."""
    name_package()
    index: list[TermIndex] = []

    def weighed(column: pa.Array) -> pa.Array:
        if not index:  # once in a task
            index.append(TermIndex(terms, idf, sizes))
        none = pa.array([], pa.list_(pa.struct(WEIGHT_FIELDS)))
        return pa.concat_arrays([none, *map(index[0].weights, chunks(column))])

    return F.arrow_udf(weighed, WEIGHTS_TYPE)(separable(text))
