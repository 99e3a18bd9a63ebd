"""Cutting texts for a byte-level BPE with word ends, chunk by chunk.

Tokens of this kind of tokenizer never span white space, so the encoding of a text is
the concatenation of the encodings of its white-space separated chunks. Chunks repeat, so
each worker remembers recent ones.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence
from functools import cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces and chunks in one generation of what a worker remembers; about 200 bytes each.
PIECES_KEPT, CHUNKS_KEPT = 400_000, 250_000

#: Tokenizer file of the query contracts; a parameter everywhere.
TOKENIZER_FILE = "word_bpe_49k.json"

# Letters and digits up to U+017F. In this range normalisation is lower-casing alone, and
# every Unicode version agrees on the classes; chunks with other characters, or with the
# marks of special tokens, are cut by the library.
_LETTERS = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
_DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_not_simple = re.compile("[^!-~\xa1-ſ]|<\\|").search
_cut = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_DIGITS}]|[^\\s{_LETTERS}{_DIGITS}]+").findall


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    symbols = {byte: chr(byte) for byte in printable} | {byte: chr(256 + at) for at, byte in enumerate(others)}
    return [symbols[byte] for byte in range(256)]


_SYMBOLS = byte_symbols()


def as_symbols(piece: str) -> str:
    return piece if piece.isascii() else "".join([_SYMBOLS[byte] for byte in piece.encode("utf-8")])


@cache
def library_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def tokenizer_path(name_or_path: str) -> str:
    """A path, or the name of one of the installed public vocabularies."""
    if os.sep in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def special_tokens(tokenizer) -> dict[str, int]:
    return {token.content: at for at, token in tokenizer.get_added_tokens_decoder().items()}


def cut_chunk(chunk: str, tokenizer) -> list[str] | None:
    """Pieces of a chunk in byte symbols; None if it holds a special token."""
    if not _not_simple(chunk):
        return [as_symbols(piece) for piece in _cut(chunk.lower())]
    if any(mark in chunk for mark in special_tokens(tokenizer)):
        return None
    normal = tokenizer.normalizer.normalize_str(chunk)
    return [piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]


class Remembered(dict):
    """A dictionary that computes missing values and keeps what was asked for lately.

    When it is full its content becomes the older generation, the one before is forgotten; keys that are still
    asked for move on, so frequent ones are not computed again.
    """

    def __init__(self, compute: Callable[[str], bytes], limit: int) -> None:
        super().__init__()
        self.compute, self.limit = compute, limit
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


def packed(ids: Sequence[int]) -> bytes:
    return np.array(ids, dtype="<i4").tobytes()


class LibraryEncoder:
    """Ids of the library for whole texts, one call to its model for each distinct piece."""

    def __init__(self, path: str) -> None:
        self.tokenizer = library_tokenizer(path)
        model = self.tokenizer.model
        self.pieces = Remembered(lambda piece: packed([token.id for token in model.tokenize(piece)]), PIECES_KEPT)
        self.chunks = Remembered(self._chunk, CHUNKS_KEPT)

    def _chunk(self, chunk: str) -> bytes:
        pieces = cut_chunk(chunk, self.tokenizer)
        if pieces is None:
            return packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, chunks: list[str]) -> bytes:
        """Little-endian 32-bit ids of a text given as its chunks."""
        return b"".join(map(self.chunks.__getitem__, chunks))


@cache
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)
