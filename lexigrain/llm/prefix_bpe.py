"""BPE encoding over a trie of distinct words, and decoding.

Byte-pair encodings can be read off prefixes: if ``last[d]`` is the last token of the
encoding of the first ``d`` symbols, then the encoding of a longer prefix ends in the one
token ``t`` that is a suffix of it and may follow ``last[d - len(t)]``, where "may follow"
means that merging the two tokens' symbols gives the two tokens back. So distinct words go
into a trie whose nodes are prefixes; the last token of a node is found depth first from those of
shorter prefixes, once for all words that share it, and a word's ids by stepping back from its end.

Spark partitions the documents; each task keeps a trie of the words it has met lately. No
shuffle, nothing on the driver, memory bounded by ``Remembered`` and the batch size.

Defined results: null text counts as empty and has no ids (an empty array) and the decoded
text ''. All other columns pass through unchanged, repeated rows stay, an empty table gives
an empty table. A column named like an output column raises ValueError.
"""

from __future__ import annotations

import gc
import json
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrain.llm.common import Batches, flat_list, list_array, small_batches, split_words, texts_of, trimmed
from lexigrain.llm.pieces import (
    TOKENIZER_FILE,
    cut_chunk,
    library_tokenizer,
    packed,
    special_tokens,
    tokenizer_path,
)

WORD_END = "</w>"
NO_RANK = 1 << 40
#: The state of a symbol for which there is no token; as the library, leave it out.
NO_TOKEN = -1
#: Words of more symbols are no nodes of a trie.
LONG_WORD = 64
#: Bytes of text whose new words share a trie.
TRIE_TEXT = 5_000_000
#: What a worker remembers at most (words: in each of two generations); results do not depend on it.
CHUNKS_KEPT, PIECES_KEPT, PAIRS_KEPT = 100_000, 125_000, 400_000


class PrefixTrie:
    """Encodes pieces (strings of byte symbols) with the merges of a tokenizer file."""

    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]]) -> None:
        self.ids = vocabulary
        self.names = {at: name for name, at in vocabulary.items()}
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(merges)}
        self.follows: dict[int, bool] = {}
        # Every suffix of a token: its id if it is a token that its own symbols give back, else -1.
        self.suffixes: dict[str, int] = {}
        for name, at in vocabulary.items():
            symbols = self.symbols(name)
            for start in range(1, len(symbols)):
                self.suffixes.setdefault("".join(symbols[start:]), -1)
            if self.merged(symbols) == [name]:
                self.suffixes[name] = at

    @staticmethod
    def symbols(name: str) -> list[str]:
        if name.endswith(WORD_END) and len(name) > len(WORD_END):
            plain = name.removesuffix(WORD_END)
            return [*plain[:-1], plain[-1] + WORD_END]
        return list(name)

    def merged(self, symbols: list[str]) -> list[str]:
        """The definition: merge the pair of lowest rank, leftmost first, until none is left."""
        rank_of = self.ranks.get
        ranks = [rank_of(pair, NO_RANK) for pair in zip(symbols, symbols[1:])]
        while ranks and (rank := min(ranks)) < NO_RANK:
            at = ranks.index(rank)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((symbols[at - 1], symbols[at]), NO_RANK)
            if at < len(ranks):
                ranks[at] = rank_of((symbols[at], symbols[at + 1]), NO_RANK)
        return symbols

    def may_follow(self, left: int, right: int) -> bool:
        a, b = self.names[left], self.names[right]
        if len(self.follows) > PAIRS_KEPT:
            self.follows.clear()
        known = self.follows[left << 32 | right] = self.merged(self.symbols(a) + self.symbols(b)) == [a, b]
        return known

    def candidates(self, word: str, depth: int, end: str) -> list[tuple[int, int]]:
        """Tokens that are a suffix of the first ``depth`` symbols, with their sizes, shortest first."""
        suffixes, found = self.suffixes, []
        for size in range(1, depth + 1):
            token = suffixes.get(word[depth - size : depth] + end)
            if token is None:
                break
            if token >= 0:
                found.append((token, size))
        return found

    def fits(self, left: int, right: int) -> bool:
        known = self.follows.get(left << 32 | right)
        return self.may_follow(left, right) if known is None else known

    def state(self, prefix: str, end: str, nodes: dict[str, tuple[int, int]]) -> tuple[int, int]:
        """Last token and its size at a node of the trie, found depth first and kept for all words
        that share the prefix."""
        known = nodes.get(prefix + end)
        if known is None:
            depth = len(prefix)
            known = (NO_TOKEN, 1)
            for token, size in reversed(self.candidates(prefix, depth, end)):
                if size == depth or self.fits(self.state(prefix[: depth - size], "", nodes)[0], token):
                    known = (token, size)
                    break
            nodes[prefix + end] = known
        return known

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Every distinct word with its ids; the work for a shared prefix is done once.

        The trie's nodes are named by their prefixes. Words too long for that are walked alone.
        """
        nodes: dict[str, tuple[int, int]] = {}
        for word in words:
            if len(word) > LONG_WORD:
                yield word, self.encode_alone(word)
                continue
            token, size = self.state(word, WORD_END, nodes)
            ids, depth = [token], len(word) - size
            while depth > 0:
                token, size = self.state(word[:depth], "", nodes)
                ids.append(token)
                depth -= size
            yield word, [at for at in reversed(ids) if at != NO_TOKEN]

    def encode_alone(self, word: str) -> list[int]:
        """The same walk along one word, in memory and time linear in its length."""
        states = [(NO_TOKEN, 1)]
        for depth in range(1, len(word) + 1):
            end = WORD_END if depth == len(word) else ""
            state = (NO_TOKEN, 1)
            for token, size in reversed(self.candidates(word, depth, end)):
                if size == depth or self.fits(states[depth - size][0], token):
                    state = (token, size)
                    break
            states.append(state)
        ids, depth = [], len(word)
        while depth > 0:
            token, size = states[depth]
            ids.append(token)
            depth -= size
        return [at for at in reversed(ids) if at != NO_TOKEN]


class Recent:
    """What has been asked for lately: a full generation becomes the old one, the one before is forgotten.

    Frequent keys move on from generation to generation, so they are not computed again.
    """

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, wanted: set[str]) -> set[str]:
        """The wanted keys that are not known; all others are in ``young`` afterwards."""
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        unknown = wanted - self.young.keys()
        known = unknown & self.old.keys()
        self.young.update((key, self.old[key]) for key in known)
        return unknown - known

    def add(self, values: dict[str, bytes]) -> None:
        self.young.update(values)

    def clear(self) -> None:
        self.young, self.old = {}, {}


class TrieEncoder:
    """Ids of whole texts; new distinct pieces of a batch go through the trie together."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [tuple(pair.split(" ")) if isinstance(pair, str) else tuple(pair) for pair in model["merges"]]
        self.tokenizer = library_tokenizer(path)
        self.special = special_tokens(self.tokenizer)
        self.trie = PrefixTrie(model["vocab"], merges)
        self.pieces, self.chunks = Recent(PIECES_KEPT), Recent(CHUNKS_KEPT)

    def split_special(self, chunk: str) -> list[str]:
        """A chunk cut at the special tokens in it, leftmost first; texts and marks alternate."""
        found = [(chunk.find(mark), -len(mark), mark) for mark in self.special if mark in chunk]
        if not found:
            return [chunk]
        at, _, mark = min(found)
        return [chunk[:at], mark, *self.split_special(chunk[at + len(mark) :])]

    def learn(self, chunks: set[str]) -> None:
        """Encode new chunks: all their new pieces go through one trie."""
        cut = {chunk: cut_chunk(chunk, self.tokenizer) for chunk in chunks}
        marked = {chunk: self.split_special(chunk) for chunk, parts in cut.items() if parts is None}
        for chunk, parts in marked.items():
            cut[chunk] = [piece for part in parts[::2] for piece in cut_chunk(part, self.tokenizer) or ()]
        new = self.pieces.missing({piece for parts in cut.values() for piece in parts})
        self.pieces.add({word: packed(ids) for word, ids in self.trie.encode_words(new)})
        known = self.pieces.young
        found = {chunk: b"".join([known[piece] for piece in parts]) for chunk, parts in cut.items()}
        for chunk, parts in marked.items():
            plain = [b"".join([known[piece] for piece in cut_chunk(part, self.tokenizer) or ()]) for part in parts[::2]]
            marks = [packed([self.special[mark]]) for mark in parts[1::2]]
            found[chunk] = b"".join(part for pair in zip(plain, [*marks, b""]) for part in pair)
        self.chunks.add(found)

    def forget(self) -> None:
        """Drop all words: workers outlive their tasks, and those of other stages need the memory."""
        self.pieces.clear()
        self.chunks.clear()

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        wanted = {chunk for text in texts for chunk in split_words(text)}
        new = self.chunks.missing(wanted)
        if new:
            gc.disable()  # thousands of small values, none of them in a cycle
            self.learn(new)
            gc.enable()
        known = self.chunks.young
        return [b"".join([known[chunk] for chunk in split_words(text)]) for text in texts]


@cache
def trie_encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


@cache
def token_table(path: str) -> list[str]:
    """What each id stands for in a decoded text, by id."""
    tokenizer = library_tokenizer(path)
    names = {at: name for name, at in tokenizer.get_vocab(with_added_tokens=True).items()}
    return [names.get(at, "") for at in range(max(names) + 1)]


def with_column(frame: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """The schema of ``frame`` with one more column, whose name must be free."""
    if name.lower() in (column.lower() for column in frame.columns):
        raise ValueError(f"the table already has a column {name}")
    return T.StructType([*frame.schema.fields, T.StructField(name, kind)])


def _encoding(run: Callable[[TrieEncoder, Batches], Batches], path: str) -> Callable[[Batches], Batches]:
    """``run`` with the encoder of this worker, which keeps its tables but no words once the task is done."""

    def wrapped(batches: Batches) -> Batches:
        encoder = trie_encoder(path)
        try:
            yield from run(encoder, batches)
        finally:
            encoder.forget()

    return trimmed(wrapped)


def _ids(encoder: TrieEncoder, texts: list[str]) -> pa.Array:
    encoded = encoder.encode_texts(texts)
    flat = np.frombuffer(b"".join(encoded), dtype="<i4")
    return list_array(flat, np.array([len(part) // 4 for part in encoded], dtype=np.int64), pa.int32())


def _decoded(table: list[str], ids: pa.Array) -> pa.Array:
    flat, offsets = flat_list(ids.fill_null([]) if ids.null_count else ids)
    parts = list(map(table.__getitem__, flat.tolist()))
    bounds = zip(offsets[:-1].tolist(), offsets[1:].tolist())
    return pa.array([" ".join(parts[start:end]) for start, end in bounds], pa.string())


def _decodable(tokenizer: str) -> str:
    path = tokenizer_path(tokenizer)
    if library_tokenizer(path).decoder is not None:
        raise ValueError("only vocabularies without a decoder of their own are supported")
    return path


def encode(documents: DataFrame, text: str = "text", ids: str = "ids", tokenizer: str = TOKENIZER_FILE) -> DataFrame:
    """``documents`` with the token ids of each whole text in a column ``ids``."""
    path = tokenizer_path(tokenizer)

    def run(encoder: TrieEncoder, batches: Batches) -> Batches:
        for batch in small_batches(batches, TRIE_TEXT, text):
            lists = _ids(encoder, texts_of(batch, text))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, ids])

    return documents.mapInArrow(_encoding(run, path), with_column(documents, ids, T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, ids: str = "ids", text: str = "decoded", tokenizer: str = TOKENIZER_FILE) -> DataFrame:
    """``encoded`` with the text of its ids; null ids give ''.

    For a vocabulary whose file names no decoder, as the library has it, this is the tokens'
    own symbols, word-end marks included, joined by single spaces.
    """
    path = _decodable(tokenizer)

    def run(batches: Batches) -> Batches:
        table = token_table(path)
        for batch in small_batches(batches, column=ids):
            whole = _decoded(table, batch.column(batch.schema.get_field_index(ids)))
            yield pa.RecordBatch.from_arrays([*batch.columns, whole], [*batch.schema.names, text])

    return encoded.mapInArrow(run, with_column(encoded, text, T.StringType()))


def round_trip(documents: DataFrame, text: str = "text", tokenizer: str = TOKENIZER_FILE) -> DataFrame:
    """``encode`` and ``decode`` in one pass: the columns ``ids`` and ``decoded`` take the place of the text."""
    path = _decodable(tokenizer)
    others = documents.drop(text)
    new = [with_column(others, "ids", T.ArrayType(T.IntegerType())), with_column(others, "decoded", T.StringType())]
    schema = T.StructType([*others.schema.fields, *(each.fields[-1] for each in new)])

    def run(encoder: TrieEncoder, batches: Batches) -> Batches:
        table = token_table(path)
        for batch in small_batches(batches, TRIE_TEXT, text):
            lists = _ids(encoder, texts_of(batch, text))
            kept = [name for name in batch.schema.names if name != text]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(name)) for name in kept), lists, _decoded(table, lists)],
                [*kept, "ids", "decoded"],
            )

    return documents.mapInArrow(_encoding(run, path), schema)


def encode_decode_digests(documents: DataFrame, tokenizer: str = TOKENIZER_FILE) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the decoded text."""
    return round_trip(documents.select("doc_id", "text"), tokenizer=tokenizer).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
