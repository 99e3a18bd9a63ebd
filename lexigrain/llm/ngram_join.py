"""Jaccard self-join of word shingles with a token-group matrix.

The join is exact for a threshold given in percent:

1. *Equal sets* are one node; copies never meet pairwise again.
2. *Candidate routing.* The token universe is cut into more segments than two sets of a size
   band may differ in tokens; so two similar sets agree in at least one whole segment.
   A node's tokens in a segment, hashed together, are its signature there. Frequent shingles
   need no statistics: a passage shared by very many texts does not make a segment equal.
3. *Families.* All nodes of a signature are compared with one of them, its leader. Verified links
   make groups; a leader and all nodes compared with it are a family, and every link lies in one.
4. *Token-group matrix.* Where a family holds more than one linked group, its members are
   partitioned into groups of neighbours by least token, and each group's token union is a row of
   bits. A member opens a group only if the union lacks no more of its tokens than the
   threshold lets differ; opened members pass the same bound one by one, then the exact test.

Signatures are dealt to tasks by hash and read as a stream, in an order fixed by their content; a task remembers
one leader for each signature, so a signature held by a third of all documents costs time in proportion but no
memory. Verification is a join whose hot keys Spark can split; large families are cut into blocks
and their block pairs dealt out, and tasks return only links that join groups up. Nothing is
collected.

Defined results: null and empty texts, and texts without words, have no shingles and are linked with
nothing; texts of fewer words than a shingle have one, the whole sequence; equal texts under
different ids link; rows are told apart by id and text, so different texts under one id, null
included, are documents of their own and link like others; the component_id of a group of null ids
only is null. ``one_of_each`` keeps one row of each group, of those with the smallest id (null
last) the one of the smallest hash of the text, and every row without shingles; an empty table gives
an empty table. Other columns pass through ``one_of_each`` whatever their names.
"""

from __future__ import annotations

from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrain.llm.common import (
    WORD_HASHES,
    Batches,
    list_array,
    lower_words,
    mix,
    small_batches,
    store,
    texts_of,
    trimmed,
)
from lexigrain.llm.components import components

#: Words of a shingle and similarity in per cent, where nothing else is asked for.
SHINGLE = 5
PERCENT = 80
NODE_SEED, PART_SEED, BAND_SEED = np.uint64(0x51F1), np.uint64(0x7A3D), np.uint64(0x2545F491)
#: Signatures a task gathers before it looks up their leaders.
BLOCK = 400_000
#: Bytes of text whose signatures are dealt out together.
DEALT_TEXT = 1_000_000
#: Members of a family compared in one task; bits of a row of the matrix; members of a group.
MEMBERS, BITS, GROUP = 512, 4096, 16


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes."""
    words = [lower_words(text) for text in texts]
    lengths = np.array([len(each) for each in words], dtype=np.int64)
    hashes = WORD_HASHES.of(list(chain.from_iterable(words)))
    with np.errstate(over="ignore"):
        rolled = mix(hashes)
        for step in range(1, size):
            rolled = mix(rolled[: len(hashes) - step] + hashes[step:]) if len(hashes) > step else rolled[:0]
    sets, at = [], 0
    for n in lengths.tolist():
        if n >= size:
            sets.append(np.unique(rolled[at : at + n - size + 1]))
        elif n:
            whole = np.array([n], dtype=np.uint64)
            with np.errstate(over="ignore"):
                for value in hashes[at : at + n]:
                    whole = mix(whole + value)
            sets.append(whole)
        else:
            sets.append(hashes[:0])
        at += n
    return sets


@cache
def band_start(band: int, percent: int) -> int:
    return band_end(band - 1, percent) + 1 if band else 1


@cache
def band_end(band: int, percent: int) -> int:
    return band_start(band, percent) * 100 // percent


def band_of(n: int, percent: int) -> int:
    band = 0
    while band_end(band, percent) < n:
        band += 1
    return band


_band_of = cache(band_of)


@cache
def segments(band: int, percent: int) -> tuple[np.ndarray, int]:
    """Upper ends of the segments in which sets that meet in a band are compared, and how many of
    them two similar sets share at least.

    There are more segments than tokens may differ: so many more that a set has hardly ever as
    many empty ones as similar sets share.
    """
    smaller = band_end(band, percent)
    larger = smaller * 100 // percent
    differ = (smaller + larger) * (100 - percent) // (100 + percent)
    number = differ + 1
    if differ:
        for _ in range(8):
            empty = number * np.exp(-band_start(band, percent) / number)
            number = differ + 2 + int(empty + 4 * np.sqrt(empty))
    return np.array([(1 << 64) * at // number for at in range(1, number)], dtype=np.uint64), number - differ


def signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of a set in its own band and, as the larger partner, in the band below.

    Empty segments have none: two similar sets share another one, unless a set has at least as many
    empty segments as similar sets share; such rare sets (and so both partners) sign those too.
    """
    if not len(tokens):
        return tokens
    own = _band_of(len(tokens), percent)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens + PART_SEED), dtype=np.uint64)])
        found = []
        for band in (own, own - 1) if own else (own,):
            edges, shared = segments(band, percent)
            bounds = np.concatenate([[0], np.searchsorted(tokens, edges), [len(tokens)]])
            filled = np.flatnonzero(np.diff(bounds) > 0)
            if len(edges) + 1 - len(filled) >= shared:
                filled = np.arange(len(edges) + 1)
            places = filled.astype(np.uint64) + np.uint64(band << 32)
            found.append(mix(np.diff(sums[bounds])[filled] + mix(places + BAND_SEED)))
    return np.concatenate(found)


def node_of(tokens: np.ndarray) -> int:
    """A hash of the whole set."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(tokens + NODE_SEED).sum(dtype=np.uint64) + np.uint64(len(tokens))])).view(np.int64)[0])


def keyed(documents: DataFrame) -> DataFrame:
    """``doc_id, text, key``: id and hash of the text tell rows apart."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key"))


def first_row() -> Column:
    """Of several rows the id and key of that of the smallest id, null last, then of the smallest key."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key"))


def shingled(documents: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, node, key``; node, the hash of the set, is null without shingles; key is that of the text."""

    def run(batches: Batches) -> Batches:
        for batch in small_batches(batches):
            sets = shingle_sets(texts_of(batch), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(tokens) for tokens in sets], pa.int64()),
                    pa.array([node_of(tokens) if len(tokens) else None for tokens in sets], pa.int64()),
                    batch.column(2),
                ],
                ["doc_id", "n_shingles", "node", "key"],
            )

    return keyed(documents).mapInArrow(trimmed(run), "doc_id long, n_shingles long, node long, key long")


def leader_pairs(documents: DataFrame, percent: int, size: int) -> DataFrame:
    """``a, b``: every node with the leader of each of its signatures, where they differ.

    Signatures are many times the size of what is known of a document otherwise, so they go
    straight from the texts to the tasks that look leaders up.
    """
    spark = documents.sparkSession
    # What a task remembers of its signatures grows with its part of them.
    parts = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = 4 * parts

    def deal(batches: Batches) -> Batches:
        """One row for each shard and batch, with the packed signatures and their nodes."""
        for batch in small_batches(batches, DEALT_TEXT):
            sets = [tokens for tokens in shingle_sets(texts_of(batch), size) if len(tokens)]
            if not sets:
                continue
            marks = [signatures(tokens, percent) for tokens in sets]
            flat = np.concatenate(marks)
            owner = np.repeat(np.array([node_of(tokens) for tokens in sets]), [len(each) for each in marks])
            shard = (flat % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            present, starts = np.unique(shard[order], return_index=True)
            lengths = np.diff([*starts, len(order)])
            with np.errstate(over="ignore"):
                place = mix(owner.view(np.uint64)).sum(dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(present, pa.int32()),
                    pa.array(np.full(len(present), place)),
                    list_array(flat[order].view(np.int64), lengths, pa.int64()),
                    list_array(owner[order], lengths, pa.int64()),
                ],
                ["shard", "place", "signature", "node"],
            )

    def lead(batches: Batches) -> Batches:
        known, leaders = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def block(marks: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
            nonlocal known, leaders
            distinct, first, inverse = np.unique(marks, return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(known, distinct), max(0, len(known) - 1))
            old = known[at] == distinct if len(known) else np.zeros(len(distinct), bool)
            leader = nodes[first]
            leader[old] = leaders[at[old]]
            known, leaders = np.concatenate([known, distinct[~old]]), np.concatenate([leaders, leader[~old]])
            order = np.argsort(known, kind="stable")
            known, leaders = known[order], leaders[order]
            b = leader[inverse]
            differ = b != nodes
            pairs = np.unique(np.stack([nodes[differ], b[differ]], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                held.append((np.asarray(part.column(2).flatten()), np.asarray(part.column(3).flatten())))
                size += len(held[-1][0])
                if size >= max(BLOCK, len(known)):
                    yield block(*map(np.concatenate, zip(*held)))
                    held, size = [], 0
        if held:
            yield block(*map(np.concatenate, zip(*held)))

    # Batches come in an order of their own content, so a task that is run again finds the same leaders.
    schema = "shard int, place long, signature array<long>, node array<long>"
    dealt = documents.select("text").mapInArrow(trimmed(deal), schema).repartition(parts, "shard").sortWithinPartitions("shard", "place")
    return dealt.mapInArrow(trimmed(lead), "a long, b long").distinct()


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of nodes with a text of either."""
    a, b = (texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}")) for side in "ab")
    return pairs.join(a, "a").join(b, "b")


def verified(pairs: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs whose sets have a Jaccard similarity of at least ``percent`` per cent."""

    def run(batches: Batches) -> Batches:
        for batch in small_batches(batches, 1_000_000, "text_a"):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            text_of = dict(zip(a, batch.column(2).to_pylist())) | dict(zip(b, batch.column(3).to_pylist()))
            sets = dict(zip(text_of, shingle_sets(list(text_of.values()), size)))
            good = []
            for x, y in zip(a, b):
                shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                good.append(100 * shared >= percent * (len(sets[x]) + len(sets[y]) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return with_texts(pairs, texts).select("a", "b", "text_a", "text_b").mapInArrow(trimmed(run), "a long, b long")


def node_texts(nodes: DataFrame, wanted: DataFrame, documents: DataFrame, size: int) -> DataFrame:
    """``node, text`` of one document of each wanted node."""
    chosen = nodes.join(wanted, "node", "left_semi").groupBy("node").agg(first_row().alias("row"))
    chosen = chosen.select("node", F.col("row.doc_id").alias("of_id"), F.col("row.key").alias("of_key"))
    rows = keyed(documents)
    named = rows.join(chosen, (F.col("doc_id") == F.col("of_id")) & (F.col("key") == F.col("of_key")))
    # Null ids do not spread rows, so copies are combined before they meet.
    nameless = rows.where("doc_id is null").select("text", "key").distinct()
    nameless = nameless.join(chosen.where("of_id is null"), F.col("key") == F.col("of_key"))
    texts = named.select("node", "text").union(nameless.select("node", "text"))

    def own(batches: Batches) -> Batches:
        """Keep the texts whose set the node is, should hashes of texts clash."""
        for batch in small_batches(batches):
            found = [node_of(tokens) if len(tokens) else None for tokens in shingle_sets(texts_of(batch), size)]
            yield batch.filter(pa.array([x == y for x, y in zip(found, batch.column(0).to_pylist())], pa.bool_()))

    kept = texts.mapInArrow(trimmed(own), "node long, text string")
    return kept.groupBy("node").agg(F.min("text").alias("text")) if nodes_repeat(nodes) else kept


def nodes_repeat(nodes: DataFrame) -> bool:
    """Whether a text with shingles stands in several rows of one id, null included."""
    return not nodes.where("node is not null").groupBy("doc_id", "key").count().where("count > 1").limit(1).isEmpty()


def families(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The families that may hold links between groups: ``family, node, grp, loose``.

    A family is a leader with all nodes that were compared with it. Nodes that share a signature
    are in the family of its leader, so every link lies in some family. Members whose group is
    not the leader's are loose; a family without loose members is one group and done.
    ``groups`` has ``node, component``; nodes without an entry are groups of their own.
    """
    of = lambda side: groups.select(F.col("node").alias(side), F.col("component").alias(f"group_{side}"))
    grouped = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        "a", "b", F.coalesce("group_a", "a").alias("group_a"), F.coalesce("group_b", "b").alias("group_b")
    )
    grouped = store(grouped.withColumn("loose", F.col("group_a") != F.col("group_b")), "jaccard-grouped")
    leaders = grouped.where("loose").select("b").distinct()
    members = grouped.join(leaders, "b", "left_semi")
    heads = members.select(F.col("b").alias("family"), F.col("b").alias("node"), F.col("group_b").alias("grp"), F.lit(False).alias("loose"))
    rest = members.select(F.col("b").alias("family"), F.col("a").alias("node"), F.col("group_a").alias("grp"), "loose")
    return rest.union(heads.distinct())


def dealt_families(members: DataFrame) -> DataFrame:
    """Members with the pairs of blocks in which they are compared: ``family, low, high, block, …``.

    A family of more than ``MEMBERS`` is cut in blocks, loose members apart from the others; only
    block pairs with a loose side are needed.
    """
    sizes = members.groupBy("family").agg(F.count_if("loose").alias("n_loose"), F.count_if(~F.col("loose")).alias("n_fast"))
    small = F.col("n_loose") + F.col("n_fast") <= MEMBERS
    cut = lambda n: F.ceil(F.col(n) / MEMBERS).cast("int")
    spot = F.pmod(F.xxhash64("node"), F.when(F.col("loose"), F.col("loose_blocks")).otherwise(F.col("fast_blocks"))).cast("int")
    placed = (
        members.join(sizes, "family")
        .withColumn("loose_blocks", F.when(small, 1).otherwise(cut("n_loose")))
        .withColumn("fast_blocks", F.when(small, 0).otherwise(cut("n_fast")))
        .withColumn("block", F.when(small, 0).when(F.col("loose"), spot).otherwise(F.col("loose_blocks") + spot))
    )
    last = F.when(F.col("block") < F.col("loose_blocks"), F.col("loose_blocks") + F.col("fast_blocks") - 1).otherwise(
        F.col("loose_blocks") - 1
    )
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return spread.select(
        "family", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "grp", "loose"
    )


def bit_rows(sets: list[np.ndarray]) -> np.ndarray:
    """Each set as a row of ``BITS`` bits. A bit that one row has and another lacks is a token that
    the other lacks, so differences are never overstated."""
    rows = np.zeros((len(sets), BITS), dtype=np.uint8)
    for at, tokens in enumerate(sets):
        rows[at, (tokens % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(rows, axis=1).view(np.uint64)


def group_links(nodes: list[int], groups: list[int], loose: list[bool], blocks: list[int], sets: list[np.ndarray], percent: int) -> list:
    """Links between members of different groups, no more than join them up.

    Members in the order of their least token make groups of ``GROUP``; a group's token union is the
    bitwise or of its rows. A group is opened for a member only if the union lacks no more of the
    member's tokens than the threshold lets differ.
    """
    order = sorted(range(len(nodes)), key=lambda at: (int(sets[at][0]), len(sets[at])))
    bits = bit_rows(sets)
    ranked = np.array(order)
    unions = np.bitwise_or.reduceat(bits[ranked], np.arange(0, len(ranked), GROUP), axis=0)
    sizes = np.array([len(tokens) for tokens in sets])
    block = np.array(blocks)
    two_blocks = len(set(blocks)) > 1
    parent = {group: group for group in groups}

    def root(group: int) -> int:
        while parent[group] != group:
            parent[group] = group = parent[parent[group]]
        return group

    links = []
    for i in np.flatnonzero(loose).tolist():
        may_lack = sizes[i] * (100 - percent) // 100
        lacks = np.bitwise_count(bits[i] & ~unions).sum(axis=1)
        for g in np.flatnonzero(lacks <= may_lack).tolist():
            opened = ranked[g * GROUP : (g + 1) * GROUP]
            fits = 100 * np.minimum(sizes[opened], sizes[i]) >= percent * np.maximum(sizes[opened], sizes[i])
            fits &= np.bitwise_count(bits[i] & ~bits[opened]).sum(axis=1) <= may_lack
            if two_blocks:
                fits &= block[opened] != block[i]
            for j in opened[fits].tolist():
                if root(groups[i]) == root(groups[j]):
                    continue
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * shared >= percent * (sizes[i] + sizes[j] - shared):
                    links.append((nodes[i], nodes[j]))
                    parent[root(groups[i])] = root(groups[j])
    return links


def links_between_groups(pairs: DataFrame, groups: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """``a, b``: links that join different groups up."""

    def search(table: pa.Table) -> pa.Table:
        column = {name: table.column(name).to_pylist() for name in ("node", "grp", "loose", "block", "text")}
        sets = shingle_sets(column["text"], size)
        links = group_links(column["node"], column["grp"], column["loose"], column["block"], sets, percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    members = store(families(pairs, groups), "jaccard-families")
    dealt = dealt_families(members).join(texts, "node")
    return dealt.groupBy("family", "low", "high").applyInArrow(search, "a long, b long")


def node_groups(documents: DataFrame, percent: int, size: int) -> tuple[DataFrame, DataFrame]:
    """The nodes of all documents, and ``node, low, row, component``: the smallest id and the first row of
    each node, and the smallest node reachable by links."""
    nodes = store(shingled(documents, size), "jaccard-nodes")
    pairs = store(leader_pairs(documents, percent, size), "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = store(node_texts(nodes, wanted, documents, size), "jaccard-texts")
    links = store(verified(pairs, texts, percent, size), "jaccard-links")
    groups = components(links)
    more = store(links_between_groups(pairs, groups, texts, percent, size), "jaccard-more")
    if not more.isEmpty():
        groups = components(links.union(more))
    ids = nodes.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"), first_row().alias("row"))
    classes = ids.join(groups, "node", "left").select("node", "low", "row", F.coalesce("component", "node").alias("component"))
    return nodes, classes


def similar_groups(documents: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` (the smallest id reachable by links) of every document."""
    nodes, classes = node_groups(documents, percent, size)
    lowest = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    labelled = classes.join(lowest, "component").select("node", "component_id")
    return nodes.join(labelled, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(documents: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One row of each group, that of the smallest id, and all rows without shingles."""
    nodes, classes = node_groups(documents, percent, size)
    first = classes.groupBy("component").agg(F.min("row").alias("row")).select("row.doc_id", "row.key", F.lit(True).alias("shingles"))
    bare = nodes.where("node is null").select("doc_id", "key", F.lit(False).alias("shingles")).distinct()
    kept = store(first.union(bare).toDF("of_id", "of_key", "shingles"), "jaccard-kept")
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key")))
    if nodes_repeat(nodes):  # of rows that share id and text keep the first by all columns
        one = rows.where("shingles").groupBy("doc_id", "key").agg(F.min_by("row", F.to_json("row")).alias("row"))
        rows = one.select("row").union(rows.where("not shingles").select("row"))
    return rows.select(*[F.col("row").getField(name).alias(name) for name in documents.columns])
