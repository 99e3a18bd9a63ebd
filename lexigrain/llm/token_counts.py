"""Token counts that follow edits.

A document is cut into leaves at white space; a tree over the leaves holds the characters and the
tokens below each node. An edit replaces some characters. Only the leaves it touches, and the
neighbours it may join words with, are encoded again; the sums on the paths to the root are
updated. Tokens never span white space, so the count stays that of a fresh encoding.

Trees are two array columns beside the text (heap order, root at place 1), built and updated where
Spark put the document: no shuffle. Edits come as an array column; ``with_edits`` joins a table of
edits by document.

Defined results: null text is empty and has no tokens; edits apply one after the other, each to the
text the earlier ones left; places beyond the end mean the end, negative ones the start; null edits
or an empty array leave the document as it is; repeated rows are edited each; an empty table
gives an empty table. Other columns pass through; clashing names raise ValueError.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrain.llm.common import Batches, list_array, small_batches, split_words, texts_of
from lexigrain.llm.pieces import TOKENIZER_FILE, LibraryEncoder, library_encoder, tokenizer_path

#: Characters of a leaf, roughly; a document is cut anew when its leaves have grown to four times that.
LEAF = 256
TREE_COLUMNS = "widths array<int>, counts array<int>"
#: White space at which leaves may begin; the next leaf begins with the word after it.
_boundary = re.compile(r"[ \t-\r](?=[^ \t-\r])").search


def token_count(encoder: LibraryEncoder, text: str) -> int:
    return len(encoder.encode(split_words(text))) // 4


def cut_leaves(text: str, size: int) -> list[str]:
    """Pieces of about ``size`` characters that end in white space before a word."""
    leaves, at = [], 0
    while len(text) - at > size:
        found = _boundary(text, at + size - 1)
        if not found:
            break
        leaves.append(text[at : found.end()])
        at = found.end()
    return [*leaves, text[at:]]


def heap(values: list[int]) -> np.ndarray:
    """Sums of a complete binary tree over the values; node k has the children 2k and 2k + 1."""
    width = 1 << max(0, len(values) - 1).bit_length()
    tree = np.zeros(2 * width, dtype=np.int32)
    tree[width : width + len(values)] = values
    while width > 1:
        tree[width // 2 : width] = tree[width : 2 * width : 2] + tree[width + 1 : 2 * width : 2]
        width //= 2
    return tree


class CountedText:
    """A document as leaves with the trees of their widths and token counts."""

    def __init__(self, encoder: LibraryEncoder, leaves: list[str], widths: np.ndarray, counts: np.ndarray) -> None:
        self.encoder, self.leaves, self.widths, self.counts = encoder, leaves, widths, counts
        self.encoded = 0  # characters that edits encoded again

    @classmethod
    def build(cls, encoder: LibraryEncoder, text: str) -> CountedText:
        leaves = cut_leaves(text, LEAF)
        return cls(encoder, leaves, heap([len(leaf) for leaf in leaves]), heap([token_count(encoder, leaf) for leaf in leaves]))

    @classmethod
    def stored(cls, encoder: LibraryEncoder, text: str, widths: np.ndarray, counts: np.ndarray) -> CountedText:
        ends = np.cumsum(widths[len(widths) // 2 :])
        number = max(1, int(np.searchsorted(ends, len(text))) + 1)
        ends = [0, *ends[:number].tolist()]
        return cls(encoder, [text[a:b] for a, b in zip(ends, ends[1:])], widths.copy(), counts.copy())

    @property
    def total(self) -> int:
        return int(self.counts[1])

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf with a character place, and the place in it, by descending the tree of widths."""
        node, half = 1, len(self.widths) // 2
        place = min(place, int(self.widths[1]))
        while node < half:
            node *= 2
            if place >= self.widths[node] and self.widths[node + 1]:
                place -= int(self.widths[node])
                node += 1
        return min(node - half, len(self.leaves) - 1), place

    def put(self, leaf: int, text: str) -> None:
        """Give a leaf a text, encode it, and update the sums above."""
        self.leaves[leaf] = text
        count = token_count(self.encoder, text)
        self.encoded += len(text)
        for tree, value in ((self.widths, len(text)), (self.counts, count)):
            node = len(tree) // 2 + leaf
            change = value - tree[node]
            while node:
                tree[node] += change
                node //= 2

    def edit(self, at: int, length: int, insert: str) -> None:
        at, size = max(0, at), int(self.widths[1])
        at = min(at, size)
        length = min(max(0, length), size - at)
        first, offset = self.leaf_at(at)
        last, end = self.leaf_at(at + length)
        # Boundary context: the leaf before, whose last word may go on, and the leaf after.
        low, high = max(0, first - 1), min(len(self.leaves) - 1, last + 1)
        head = "".join(self.leaves[low:first]) + self.leaves[first][:offset]
        tail = self.leaves[last][end:] + "".join(self.leaves[last + 1 : high + 1])
        region = head + insert + tail
        slots = high - low + 1
        if len(region) > 4 * LEAF * slots:  # grown too much: cut the whole document anew, keep what was not touched
            leaves = [*self.leaves[:low], *cut_leaves(region, LEAF), *self.leaves[high + 1 :]]
            kept = self.counts[len(self.counts) // 2 :].tolist()
            new = [token_count(self.encoder, leaf) for leaf in leaves[low : len(leaves) - (len(self.leaves) - 1 - high)]]
            self.encoded += len(region)
            counts = [*kept[:low], *new, *kept[high + 1 : len(self.leaves)]]
            self.leaves, self.widths, self.counts = leaves, heap([len(leaf) for leaf in leaves]), heap(counts)
            return
        parts = cut_leaves(region, max(1, -(-len(region) // slots)))
        parts = [*parts[: slots - 1], "".join(parts[slots - 1 :])]
        for k in range(slots):
            self.put(low + k, parts[k] if k < len(parts) else "")


def count_trees(documents: DataFrame, tokenizer: str = TOKENIZER_FILE) -> DataFrame:
    """``documents`` with the trees ``widths`` and ``counts`` of their texts."""
    path = tokenizer_path(tokenizer)
    _free(documents, "widths", "counts")

    def run(batches: Batches) -> Batches:
        encoder = library_encoder(path)
        for batch in small_batches(batches):
            built = [CountedText.build(encoder, text) for text in texts_of(batch)]
            trees = [
                list_array(np.concatenate(each), np.array([len(tree) for tree in each]), pa.int32())
                for each in ([text.widths for text in built], [text.counts for text in built])
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *trees], [*batch.schema.names, "widths", "counts"])

    return documents.mapInArrow(run, f"{_ddl(documents)}, {TREE_COLUMNS}")


def _free(frame: DataFrame, *names: str) -> None:
    clash = {name.lower() for name in names} & {name.lower() for name in frame.columns}
    if clash:
        raise ValueError(f"the table already has columns {sorted(clash)}")


def _ddl(frame: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in frame.dtypes)


def apply_edits(trees: DataFrame, edits: str = "edits", tokenizer: str = TOKENIZER_FILE) -> DataFrame:
    """Texts and trees after the edits of each row, with ``tokens_before``, ``tokens_after`` and
    ``encoded_chars``, the characters that had to be encoded again.

    ``edits`` is an array of structs ``at, length, insert``.
    """
    path = tokenizer_path(tokenizer)
    _free(trees, "tokens_before", "tokens_after", "encoded_chars")
    names = [name for name in trees.columns if name != edits]
    frame = trees.select(*names, edits)

    def run(batches: Batches) -> Batches:
        encoder = library_encoder(path)
        for batch in small_batches(batches):
            column = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()  # noqa: E731, B023
            documents, before, done = [], [], batch.num_rows
            for text, widths, counts, changes in zip(texts_of(batch), column("widths"), column("counts"), column(edits)):
                document = CountedText.stored(encoder, text, np.array(widths, np.int32), np.array(counts, np.int32))
                before.append(document.total)
                for change in changes or ():
                    if change is not None:
                        document.edit(change["at"] or 0, change["length"] or 0, change["insert"] or "")
                documents.append(document)
            new = {
                "text": pa.array(["".join(document.leaves) for document in documents], pa.string()),
                "widths": pa.array([document.widths for document in documents], pa.list_(pa.int32())),
                "counts": pa.array([document.counts for document in documents], pa.list_(pa.int32())),
            }
            columns = [new.get(name, batch.column(batch.schema.get_field_index(name))) for name in names]
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array(before, pa.int64()),
                    pa.array([document.total for document in documents], pa.int64()),
                    pa.array([document.encoded for document in documents], pa.int64()),
                ],
                [*names, "tokens_before", "tokens_after", "encoded_chars"],
            )

    kinds = f"{_ddl(trees.select(*names))}, tokens_before long, tokens_after long, encoded_chars long"
    return frame.mapInArrow(run, kinds)


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Join a table ``doc_id, seq, at, length, insert``; a document's edits in the order of ``seq``."""
    listed = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "at", "length", "insert"))).alias("edits"))
    plain = F.transform("edits", lambda e: F.struct(e["at"].alias("at"), e["length"].alias("length"), e["insert"].alias("insert")))
    return trees.join(listed.withColumn("edits", plain), "doc_id", "left")


def revision(text: Column) -> Column:
    """The edits of the query: a phrase in the middle, some characters cut, a word joined at the end."""
    size = F.length(F.coalesce(text, F.lit("")))
    one = lambda at, length, insert: F.struct(
        at.cast("int").alias("at"), F.lit(length).alias("length"), F.lit(insert).alias("insert")
    )
    return F.array(
        one(F.floor(size / 2), 0, " revised and extended, "), one(F.floor(size / 4), 37, ""), one(size + 100, 0, "end it's 2026"),
    )


def revised_counts(documents: DataFrame) -> DataFrame:
    """Token counts of every document before and after a fixed revision."""
    trees = count_trees(documents.select("doc_id", "text")).withColumn("edits", revision(F.col("text")))
    return apply_edits(trees).select(
        "doc_id", "tokens_before", "tokens_after", "encoded_chars", F.length("text").cast("long").alias("n_chars")
    )
