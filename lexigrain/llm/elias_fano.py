"""Elias-Fano sequences and the word -> context trie built of them, as flat buffers.

A non-decreasing sequence of n numbers below u keeps the low log2(u/n) bits of each in a packed
array and the rest in unary. Both are plain buffers used in place (from a memory map or an Arrow
column); a search reads one bucket of the unary part and compares low bits there.
"""

from __future__ import annotations

import json

import numpy as np


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each value, one after the other, as 64-bit words."""
    size = len(values) * width // 64 + 2
    if not width or not len(values):
        return np.zeros(size, dtype=np.uint64)
    words = np.zeros(size, dtype=np.uint64)
    at = np.arange(len(values), dtype=np.int64) * width
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    low = values << shift
    np.bitwise_or.at(words, word, low)
    over = (at & 63) + width > 64
    np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


def read_bits(words: np.ndarray, index: np.ndarray, width: int) -> np.ndarray:
    """The values at some places of a packed array."""
    if not width:
        return np.zeros(len(index), dtype=np.uint64)
    at = index * width
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return (low | high) & np.uint64((1 << width) - 1)


class EliasFano:
    """A non-decreasing sequence of unsigned numbers."""

    def __init__(self, size: int, width: int, lows: np.ndarray, unary: np.ndarray) -> None:
        self.size, self.width, self.lows, self.unary = size, width, lows, unary
        bits = np.unpackbits(unary, bitorder="little")
        zeros = np.flatnonzero(bits == 0)
        #: Where each bucket of equal high bits starts; one entry for each zero of the unary part.
        self.starts = np.concatenate([[0], zeros - np.arange(len(zeros))])

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        width = max(0, (universe // max(1, n)).bit_length() - 1)
        highs = (values >> np.uint64(width)).astype(np.int64)
        bits = np.zeros((int(highs[-1]) if n else 0) + n + 2, dtype=np.uint8)
        bits[highs + np.arange(n)] = 1
        return cls(n, width, pack_bits(values & np.uint64((1 << width) - 1), width), np.packbits(bits, bitorder="little"))

    def values(self, index: np.ndarray) -> np.ndarray:
        """Random access."""
        highs = np.searchsorted(self.starts, index, side="right") - 1
        return highs.astype(np.uint64) << np.uint64(self.width) | read_bits(self.lows, index, self.width)

    def successors(self, wanted: np.ndarray) -> np.ndarray:
        """For each number the place of the first element that is not smaller."""
        wanted = np.asarray(wanted, dtype=np.uint64)
        bucket = wanted >> np.uint64(self.width)
        last = np.uint64(len(self.starts) - 2)
        inside = bucket <= last
        bucket = np.minimum(bucket, last).astype(np.int64)
        low, high = self.starts[bucket].copy(), self.starts[bucket + 1].copy()
        low[~inside], high[~inside] = self.size, self.size
        target = wanted & np.uint64((1 << self.width) - 1)
        open_ = np.flatnonzero(low < high)
        while len(open_):  # binary search in the bucket
            middle = (low[open_] + high[open_]) >> 1
            less = read_bits(self.lows, middle, self.width) < target[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < high[open_]]
        return low

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each number, -1 where it is no element."""
        at = self.successors(wanted)
        found = at < self.size
        found[found] = self.values(at[found]) == np.asarray(wanted, dtype=np.uint64)[found]
        return np.where(found, at, -1)


#: Steps of quantised logarithms (base 10).
STEP = 1e-3


def quantised(logs: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(logs / STEP), 0, 65535).astype(np.uint16)


class NgramTrie:
    """Words (64-bit hashes) with counts and back-off weights; below each, the contexts seen before it.

    Level 1 is the sequence of words, with a monotone pointer to the first context of each.
    Level 2 holds contexts (32-bit hashes) made monotone by their word's place; a context is
    searched relative to its word.
    """

    PARTS = ("words_low", "words_unary", "pointers_low", "pointers_unary", "contexts_low", "contexts_unary", "counts", "backoff", "gains")

    def __init__(self, words: EliasFano, pointers: EliasFano, contexts: EliasFano, counts, backoff, gains) -> None:
        self.words, self.pointers, self.contexts = words, pointers, contexts
        self.counts, self.backoff, self.gains = counts, backoff, gains

    @classmethod
    def build(cls, words, counts, backoff_logs, context_words, contexts, gain_logs) -> NgramTrie:
        """``words`` sorted and distinct; ``context_words`` are the upper 32 bits of the words the
        contexts belong to, entries in any order; a context whose word is absent is left out."""
        uppers = words >> np.uint64(32)
        place = np.minimum(np.searchsorted(uppers, context_words), max(0, len(uppers) - 1))
        known = uppers[place] == context_words if len(uppers) else np.zeros(len(contexts), bool)
        place, contexts, gain_logs = place[known], contexts[known], gain_logs[known]
        relative = place.astype(np.uint64) << np.uint64(32) | contexts.astype(np.uint64)
        order = np.argsort(relative, kind="stable")
        pointers = np.searchsorted(place[order], np.arange(len(words) + 1))
        return cls(
            EliasFano.build(words),
            EliasFano.build(pointers),
            EliasFano.build(relative[order]),
            counts.astype(np.int64),
            quantised(-backoff_logs),
            quantised(gain_logs[order]),
        )

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place (-1: unknown), count and back-off logarithm of words."""
        at = self.words.find(words)
        known = at >= 0
        counts, backoff = np.zeros(len(words), np.int64), np.zeros(len(words))
        counts[known] = self.counts[at[known]]
        backoff[known] = -STEP * self.backoff[at[known]]
        return at, counts, backoff

    def gains_of(self, places: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """What a context adds to the logarithm at the word of a place; 0 if it was not kept."""
        gains = np.zeros(len(places))
        asked = np.flatnonzero(places >= 0)
        if len(asked) and self.contexts.size:
            # Words that share their upper half share the contexts of the first of them.
            upper = self.words.values(places[asked]) >> np.uint64(32)
            first = self.words.successors(upper << np.uint64(32))
            at = self.contexts.find(first.astype(np.uint64) << np.uint64(32) | contexts[asked].astype(np.uint64))
            gains[asked[at >= 0]] = STEP * self.gains[at[at >= 0]]
        return gains

    def buffer(self) -> bytes:
        """All levels as one buffer that ``open`` uses in place."""
        sequences = (self.words, self.pointers, self.contexts)
        arrays = [part for each in sequences for part in (each.lows, each.unary)] + [self.counts, self.backoff, self.gains]
        padded = [array.tobytes() + b"\0" * (-array.nbytes % 8) for array in arrays]
        head = {"sizes": [each.size for each in sequences], "widths": [each.width for each in sequences],
                "parts": [[str(array.dtype), len(array)] for array in arrays]}
        text = json.dumps(head).encode()
        text += b" " * (-(len(text) + 8) % 8)
        return len(text).to_bytes(8, "little") + text + b"".join(padded)

    @classmethod
    def open(cls, buffer) -> NgramTrie:
        """A trie over a buffer, for example a memory-mapped file."""
        view = memoryview(buffer)
        at = 8 + int.from_bytes(view[:8], "little")
        head = json.loads(bytes(view[8:at]))
        arrays = []
        for kind, length in head["parts"]:
            array = np.frombuffer(view, dtype=kind, count=length, offset=at)
            arrays.append(array)
            at += array.nbytes + (-array.nbytes % 8)
        sequences = [
            EliasFano(size, width, *arrays[2 * k : 2 * k + 2])
            for k, (size, width) in enumerate(zip(head["sizes"], head["widths"]))
        ]
        return cls(*sequences, *arrays[6:])
