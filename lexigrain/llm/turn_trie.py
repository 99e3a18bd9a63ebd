"""A prefix trie over conversations, built as a burst trie.

Turns become 128-bit ids (of role and text), a conversation is one row of turn ids. Equal conversations are
folded first, so a conversation that is copied any number of times is one row with a count. All
sequences start in one suffix container under the trie's root. A container of more than ``limit`` turns
bursts: the turns that all its sequences share become a run of trie heads, and the rest is
dealt to new containers by the next turn id, in rounds, until every container is small or a single sequence. A
round is one aggregation by container; sequences that end where their container bursts stay at
the head. What remains is sorted within its shard and swept once: neighbours' common prefixes give
the nodes, and a backward pass over a container's nodes sums its subtrees. Heads then add up their
containers, in aggregations over one row per container and head.

No task holds more than one container and one sequence. Containers are dealt by their id, the
path to it, so a first turn that a third of all conversations share is spread over many shards.

A node is named by its smallest member and its depth; the turn ids never leave the tables.

Defined results: a null role or text is empty; turns are ordered by turn number, null first, equal numbers
by turn id; rows without ``conv_id`` belong to no conversation and are left out; equal rows are turns of their
own; an empty table gives no node; other columns, whatever their names, are ignored. ``conv_id`` may
be negative (remainders as in SQL). A conversation is one row of 20 bytes a turn: up to 100 million turns.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexigrain.llm.common import Batches, store

#: Turns of the suffixes that a container may hold.
LIMIT = 8_192
#: 2 to this power neighbouring ids at most are joined in one row when a node's members are digested.
BLOCK_BITS = 8
#: Conversations of a group share the first turns of its first one, up to so many.
GROUP, MOST_SHARED = 100, 6

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_IDS, _POINTS = "array<binary>", "array<int>"
_NODE_ROW = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NODE = [field.split()[0] for field in _NODE_ROW.split(", ")]
_CLOSED, _ENDED, _OPEN = 0, 1, 2


def _digest(value: Column) -> Column:
    """16 bytes that name a binary value."""
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def conversation_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, ids, points``: the turn ids of each conversation in order, and the code points of their texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    marked = F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", _digest(marked).alias("id"), F.length(text).alias("points")).alias("turn"),
    )
    # Conversations of a group meet in one task, where they also find its first one.
    grouped = turns.withColumn("of", F.col("conv_id") - F.col("conv_id") % GROUP).repartition("of")
    return grouped.groupBy("of", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")).select(
        "of",
        "conv_id",
        F.transform("turns", lambda turn: turn["id"]).alias("ids"),
        F.transform("turns", lambda turn: turn["points"]).alias("points"),
    )


def rebuilt(rows: DataFrame) -> DataFrame:
    """Conversations that begin with the first turns of the first one of their group and go on with their own."""
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MOST_SHARED)).cast("int")
    whole = Window.partitionBy("of")

    def spliced(name: str, kind: str) -> Column:
        first = F.max(F.when(F.col("conv_id") == F.col("of"), F.slice(name, 1, MOST_SHARED - 1))).over(whole)
        lead = F.slice(F.coalesce(first, F.array().cast(kind)), F.lit(1), shared)
        own = F.slice(name, shared + 1, F.greatest(F.size(name), F.lit(1)))
        return F.concat(lead, own).alias(name)

    return rows.select("conv_id", spliced("ids", _IDS), spliced("points", _POINTS))


# --------------------------------------------------------------------- equal conversations
def _streamed_digests(blocks: DataFrame) -> DataFrame:
    """``conv_id, ends_sha256`` of sequences whose members fill several blocks.

    A digest of one text is a chain, so a node's blocks pass through one task, as rows of many
    ids each, with nothing held but the hash.
    """

    def run(batches: Batches) -> Batches:
        now, state = None, None
        for batch in batches:
            done: tuple[list[int], list[str]] = ([], [])
            for conv_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if conv_id != now:
                    if state:
                        done[0].append(now)
                        done[1].append(state.hexdigest())
                    now, state = conv_id, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.int64()), pa.array(done[1], pa.string())], ["conv_id", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "ends_sha256"])

    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "members")
    return ordered.mapInArrow(run, "conv_id long, ends_sha256 string")


def distinct_sequences(rows: DataFrame) -> DataFrame:
    """``ids, points, n, conv_id, ends_sha256``: each sequence once, its members' number, the least and their digest."""
    block = F.shiftright("conv_id", BLOCK_BITS)
    members = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda id: id.cast("string")), ",")
    blocks = store(
        rows.groupBy("ids", "points", block.alias("block")).agg(
            members.alias("members"), F.count("*").alias("n"), F.min("conv_id").alias("conv_id")
        ),
        "trie-blocks",
    )
    sequences = blocks.groupBy("ids", "points").agg(
        F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.min("members").alias("members"), F.count("*").alias("blocks")
    )
    single = sequences.where("blocks = 1").withColumn("ends_sha256", F.sha2(F.col("members").cast("binary"), 256))
    several = sequences.where("blocks > 1").drop("members")
    parts = several.select("ids", "points", "conv_id").join(blocks.drop("conv_id", "n"), ["ids", "points"])
    digested = several.join(_streamed_digests(parts), "conv_id")
    names = ["ids", "points", "n", "conv_id", "ends_sha256"]
    return single.select(*names).unionByName(digested.select(*names))


# ----------------------------------------------------------------------------- bursting
def _common(low: Column, high: Column) -> Column:
    """Length of the common prefix of two arrays."""
    shorter = F.least(F.size(low), F.size(high))
    places = F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>"))
    unequal = F.filter(places, lambda at: F.get(low, at) != F.get(high, at))
    return F.coalesce(F.get(unequal, F.lit(0)), shorter)


def _oversized(open_rows: DataFrame, limit: int) -> DataFrame:
    """``container, base, end, points, heads`` of containers to burst.

    All sequences share the turns up to ``end``: the common prefix of the least and the greatest.
    ``points`` are those of the nodes at depths ``base`` to ``end``.
    """
    ends = [f(F.struct("ids", "points")).alias(name) for f, name in ((F.min, "low"), (F.max, "high"))]
    sums = open_rows.groupBy("container").agg(
        F.count("*").alias("rows"), F.sum(F.size("ids") - F.col("base") + 1).alias("turns"),
        F.min("base").alias("base"), F.min("heads").alias("heads"), *ends,
    )
    big = sums.where((F.col("rows") > 1) & (F.col("turns") > limit)).withColumn("end", _common(F.col("low.ids"), F.col("high.ids")))
    run = F.concat(F.array(F.lit(0)), F.col("low.points"))  # the root has no text
    return big.select("container", "base", "end", F.slice(run, F.col("base") + 1, F.col("end") - F.col("base") + 1).alias("points"), "heads")


def burst(sequences: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Tables of settled rows (closed or ended) and tables of burst containers, one of each per round."""
    state = store(
        sequences.select(
            "*", F.lit(b"\0" * 16).alias("container"), F.lit(0).alias("base"),
            F.array().cast(_IDS).alias("heads"), F.lit(_OPEN).alias("state"),
        ),
        "trie-rows",
    )
    settled, burst_containers = [], []
    while True:
        open_rows = state.where(F.col("state") == _OPEN)
        big = store(_oversized(open_rows, limit), "trie-burst")
        if big.isEmpty():
            return [*settled, open_rows.withColumn("state", F.lit(_CLOSED))], burst_containers
        burst_containers.append(big)
        met = open_rows.drop("state").join(big.select("container", F.col("end").alias("e")), "container", "left")
        stays, ended = F.col("e").isNull(), F.size("ids") == F.col("e")
        moves = ~stays & ~ended
        next_turn = F.get("ids", F.col("e"))
        state = store(
            met.select(
                "ids", "points", "n", "conv_id", "ends_sha256",
                F.when(moves, _digest(F.concat("container", next_turn))).otherwise(F.col("container")).alias("container"),
                F.when(moves, F.col("e") + 1).otherwise(F.col("base")).alias("base"),
                F.when(stays, F.col("heads")).otherwise(F.concat("heads", F.array("container"))).alias("heads"),
                F.when(stays, F.lit(_CLOSED)).when(ended, F.lit(_ENDED)).otherwise(F.lit(_OPEN)).alias("state"),
            ),
            "trie-rows",
        )
        settled.append(state.where(F.col("state") != _OPEN))


# -------------------------------------------------------------------------- the sweep
class _Container:
    """The nodes of one container, filled from its sorted sequences."""

    def __init__(self, base: int, heads: list[bytes], points: list[int]) -> None:
        self.base, self.heads, self.before = base, heads, None
        self.path: list[int] = []
        self.conv_id: list[int | None] = []
        self.depth: list[int] = []
        self.parent: list[int] = []
        self.n: list[int] = []
        self.points: list[int] = []
        self.ends: list[str] = []
        self._open(base, points[base - 1] if base else 0)

    def _open(self, depth: int, points: int) -> None:
        self.parent.append(self.path[-1] if self.path else -1)
        self.path.append(len(self.depth))
        self.conv_id.append(None)
        self.depth.append(depth)
        self.n.append(0)
        self.points.append(points)
        self.ends.append(EMPTY_SHA256)

    def add(self, ids: list[bytes], points: list[int], n: int, conv_id: int, ends: str) -> None:
        depth = self.base
        if self.before is not None:
            most = min(len(ids), len(self.before))
            while depth < most and ids[depth] == self.before[depth]:
                depth += 1
        del self.path[depth - self.base + 1 :]
        for at in range(depth, len(ids)):
            self._open(at + 1, points[at])
        self.before, last = ids, self.path[-1]
        self.n[last], self.conv_id[last], self.ends[last] = n, conv_id, ends

    def columns(self) -> list[list]:
        """The columns of a node row for every node; parents stand before their children."""
        size = len(self.n)
        children, leaves, saved = [0] * size, [0] * size, [0] * size
        n, conv_id, parent = self.n, self.conv_id, self.parent
        for at in range(size - 1, -1, -1):
            saved[at] += (n[at] - 1) * self.points[at]
            leaves[at] = leaves[at] or 1
            above = parent[at]
            if above >= 0:
                n[above] += n[at]
                children[above] += 1
                leaves[above] += leaves[at]
                saved[above] += saved[at]
                if conv_id[above] is None or conv_id[at] < conv_id[above]:
                    conv_id[above] = conv_id[at]
        parents = [conv_id[above] if above >= 0 else None for above in parent]
        return [conv_id, self.depth, parents, n, children, leaves, saved, self.ends, [self.heads] + [None] * (size - 1)]


def sweep(rows: DataFrame, flush: int = 20_000) -> DataFrame:
    """Nodes of all containers; ``heads`` is set for a container's top node only."""

    def batch_of(done: list[_Container]) -> pa.RecordBatch:
        columns = [sum(parts, []) for parts in zip(*[container.columns() for container in done])]
        kinds = [pa.int64()] * 7 + [pa.string(), pa.list_(pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], [*_NODE, "heads"])

    def run(batches: Batches) -> Batches:
        now, done, held, name = None, [], 0, None
        for batch in batches:
            for key, base, heads, *row in zip(*[column.to_pylist() for column in batch.columns]):
                if key != name:
                    if now:
                        done.append(now)
                        held += len(now.n)
                        if held >= flush:
                            yield batch_of(done)
                            done, held = [], 0
                    now, name = _Container(base, heads, row[1]), key
                now.add(*row)
        if now:
            yield batch_of([*done, now])

    order = ["container", "base", "heads", "ids", "points", "n", "conv_id", "ends_sha256"]
    shards = rows.select(*order).repartition("container").sortWithinPartitions("container", "ids")
    return shards.mapInArrow(run, f"{_NODE_ROW}, heads {_IDS}")


# ------------------------------------------------------------------------------ heads
def _head_table(burst_containers: DataFrame, tops: DataFrame, ended: DataFrame) -> DataFrame:
    """One row per run of heads with its members, children, leaves and savings."""
    none = F.lit(0).cast("long")
    below = tops.select("heads", "n_convs", "conv_id", "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends"))
    at_head = ended.select("heads", F.col("n").alias("n_convs"), "conv_id", none.alias("n_leaves"), none.alias("saved_tokens"), F.col("ends_sha256").alias("ends"))
    each = below.unionByName(at_head).select("*", F.posexplode("heads").alias("level", "head"))
    last = F.col("level") == F.size("heads") - 1
    sums = each.groupBy("head").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("below"), F.max(F.when(last, F.col("ends"))).alias("ends"),
        F.count_if(last & F.col("ends").isNull()).alias("containers"),
    )
    own = (F.col("n_convs") - 1) * F.aggregate("points", none, lambda total, points: total + points)
    heads = store(burst_containers.withColumnRenamed("container", "head").join(sums, "head").withColumn("own", own), "trie-heads")
    from_heads = (
        heads.select("own", "head", F.posexplode("heads").alias("level", "above"), F.size("heads").alias("levels"))
        .groupBy(F.col("above").alias("head"))
        .agg(F.sum("own").alias("owned"), F.count_if(F.col("level") == F.col("levels") - 1).alias("runs"))
    )
    zero = lambda name: F.coalesce(name, none)
    full = heads.join(from_heads, "head", "left").select(
        "head", "base", "end", "points", "n_convs", "conv_id", "n_leaves", "ends", F.get("heads", F.size("heads") - 1).alias("above"),
        (F.col("below") + zero("owned")).alias("below"), (F.col("containers") + zero("runs")).alias("children"),
    )
    return store(full, "trie-heads")


def _parents(heads: DataFrame) -> DataFrame:
    return heads.select(F.col("head").alias("above"), F.col("conv_id").alias("above_conv_id"))


def _head_nodes(heads: DataFrame) -> DataFrame:
    """The nodes of each run of heads, one per depth."""
    none = F.lit(0).cast("long")
    nodes = heads.join(_parents(heads), "above", "left").select("*", F.posexplode("points").alias("at", "_"))
    is_last = F.col("base") + F.col("at") == F.col("end")
    rest = F.aggregate(F.slice("points", F.col("at") + 1, F.size("points")), none, lambda total, points: total + points)
    return nodes.select(
        "conv_id",
        (F.col("base") + F.col("at")).cast("long").alias("depth"),
        F.when(F.col("at") > 0, F.col("conv_id")).otherwise(F.col("above_conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(is_last, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("below") + (F.col("n_convs") - 1) * rest).alias("saved_tokens"),
        F.coalesce(F.when(is_last, F.col("ends")), F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def trie_nodes(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Every node of the trie of ``conv_id, ids, points`` rows.

    ``conv_id`` is a node's smallest member, ``depth`` the length of its prefix; ``saved_tokens`` sums, over the
    subtree, the code points of a node's text times the members beyond the first.
    """
    settled, burst_containers = burst(distinct_sequences(rows), limit)
    rows = reduce(DataFrame.unionByName, settled)
    swept = store(sweep(rows.where(F.col("state") == _CLOSED)), "trie-nodes")
    if not burst_containers:
        return swept.select(*_NODE)
    tops = swept.where(F.col("heads").isNotNull())
    heads = _head_table(reduce(DataFrame.unionByName, burst_containers), tops, rows.where(F.col("state") == _ENDED))
    under = tops.withColumn("above", F.get("heads", F.size("heads") - 1)).join(_parents(heads), "above", "left")
    found = under.withColumn("parent_conv_id", F.col("above_conv_id"))
    inner = swept.where(F.col("heads").isNull())
    return inner.select(*_NODE).unionByName(found.select(*_NODE)).unionByName(_head_nodes(heads))


def rebuilt_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The trie of the conversations after each took over its group's first turns."""
    return trie_nodes(rebuilt(conversation_rows(conversations)), limit)


#: The same nodes in DuckDB's SQL: every prefix of every conversation as a text of its own.
ORACLE = rf"""
WITH RECURSIVE steps(k, byte, value) AS (
  SELECT 0, b, b::BIGINT FROM range(256) r(b)
  UNION ALL
  SELECT k + 1, byte, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384::BIGINT) ELSE value >> 1 END FROM steps WHERE k < 8
), lookup AS (SELECT list(value ORDER BY byte) AS entries FROM steps WHERE k = 8),
turns AS (
  SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
    length(coalesce(text, ''))::BIGINT AS points, turn
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(points ORDER BY turn NULLS FIRST, id) AS points
  FROM turns GROUP BY conv_id
), shared AS (
  SELECT own.*, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda digit: ascii(digit)::BIGINT)),
    lambda crc, byte: xor(crc >> 8, entries[(xor(crc, byte) & 255) + 1])), 4294967295::BIGINT) % {MOST_SHARED} AS h
  FROM own, lookup
), rebuilt AS (
  SELECT s.conv_id,
    list_concat(coalesce(f.ids[1:s.h], []), s.ids[s.h + 1:]) AS ids,
    list_concat(coalesce(f.points[1:s.h], []), s.points[s.h + 1:]) AS points
  FROM shared s LEFT JOIN own f ON f.conv_id = s.conv_id - s.conv_id % {GROUP}
), members AS (
  SELECT conv_id, depth, ids[1:depth] AS prefix, CASE WHEN depth = 0 THEN 0 ELSE points[depth] END AS points, depth = len(ids) AS is_end
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS depth FROM rebuilt)
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS least, count(*) AS n_convs, any_value(points) AS points,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM members GROUP BY prefix, depth
), of_member AS (SELECT conv_id, depth, least FROM members JOIN nodes USING (prefix, depth)),
linked AS (
  SELECT nodes.*, above.least AS parent FROM nodes
  LEFT JOIN of_member above ON above.conv_id = nodes.least AND above.depth = nodes.depth - 1
), children AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT linked.*, coalesce(n_children, 0) AS n_children
  FROM linked LEFT JOIN children ON children.parent = linked.least AND children.depth = linked.depth
), subtrees AS (
  SELECT above.least, above.depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * points) AS saved_tokens
  FROM counted JOIN of_member above ON above.conv_id = counted.least AND above.depth <= counted.depth
  GROUP BY above.least, above.depth
)
SELECT least AS conv_id, depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM counted JOIN subtrees USING (least, depth)
"""
