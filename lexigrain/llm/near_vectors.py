"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors are projected on many random lines. In a *table*, the values on a few lines are
cut into runs of one width at a random offset; vectors of the same runs on all lines of a table
meet. For every pair that meets, collisions are counted: on how many of further lines does the
one lie in a window centred on the other. A pair that reaches the count is verified by its
cosine in double precision.

Calibration, all from the similarity sought and the number of vectors: the count is the largest
that a pair at exactly the threshold reaches with a probability of ``COUNT_RECALL``; lines per table
grow with the logarithm of the number of vectors, so that few unrelated vectors meet; tables are as
many as give such a pair a probability of ``TABLE_RECALL`` to meet. Closer pairs do better.

Equal vectors are one class with a weight. A cell with more than ``BLOCK`` classes is cut in blocks
and its block pairs are dealt out, so no task holds a hot cell. Tasks return links counted per class
and a spanning forest, never all pairs; a pair counts in the first table it meets in.

Defined results: vectors that are null, zero, or hold null or non-finite components link with
nothing; vectors of different length never link; a repeated row counts as another vector; vectors with
a null vec_id link like others, and a null is a component's id only where it has no other, where all
its rows are kept; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from math import comb, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrain.llm.common import Batches, mix, store
from lexigrain.llm.components import components

COSINE = 0.95
RUN_WIDTH, WINDOW, COUNTERS = 1.5, 0.45, 32
TABLE_RECALL, COUNT_RECALL = 0.98, 0.995
BLOCK = 1024
#: Unrelated vectors that may meet a vector in one table, roughly.
STRANGERS = 16
SEED = 7


def run_probability(distance: float, width: float = RUN_WIDTH) -> float:
    """Probability that two points at a distance fall into the same run on a random line."""
    r = width / distance
    return erf(r / sqrt(2)) - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


def needed_count(distance: float, recall: float = COUNT_RECALL) -> int:
    """The largest count that a pair at this distance reaches with the given probability."""
    p = erf(WINDOW / distance / sqrt(2))
    tail, count = 0.0, COUNTERS + 1
    while tail < recall:
        count -= 1
        tail += comb(COUNTERS, count) * p**count * (1 - p) ** (COUNTERS - count)
    return count


@dataclass(frozen=True)
class Projections:
    """The lines of all tables and of the counters for vectors of one length."""

    length: int
    lines: int
    tables: int

    @classmethod
    def calibrated(cls, length: int, vectors: int, cosine: float = COSINE) -> Projections:
        lines = max(6, round(log(max(1.0, vectors / STRANGERS)) / -log(run_probability(sqrt(2)))))
        meet = run_probability(sqrt(2 - 2 * cosine)) ** lines
        return cls(length, lines, max(1, int(np.ceil(log(1 - TABLE_RECALL) / log(1 - meet)))))

    @cached_property
    def drawn(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        random = np.random.default_rng([SEED, self.length])
        counters = random.standard_normal((self.length, COUNTERS))
        lines = random.standard_normal((self.length, self.tables * self.lines))
        return lines, random.uniform(0, RUN_WIDTH, self.tables * self.lines), counters

    def cells(self, units: np.ndarray) -> np.ndarray:
        """The cell of each vector in each table as a hash."""
        lines, offsets, _ = self.drawn
        runs = np.floor((units @ lines + offsets) / RUN_WIDTH).astype(np.int64).view(np.uint64)
        runs = runs.reshape(len(units), self.tables, self.lines)
        state = np.broadcast_to(mix(np.arange(self.tables, dtype=np.uint64) + np.uint64(self.length << 32)), runs.shape[:2])
        with np.errstate(over="ignore"):
            for at in range(self.lines):
                state = mix(state + runs[:, :, at])
        return state.view(np.int64)


def unit_vectors(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision of an Arrow list column whose lists have one length."""
    flat = np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)
    # Vectors whose squares would leave the range of doubles are scaled first; all others stay as they are.
    peak = np.abs(flat).max(axis=1, initial=0, keepdims=True)
    wild = (peak > 1e100) | (peak < 1e-100)
    if wild.any():
        flat = np.where(wild, flat / peak, flat)
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    other_than_zero = F.exists("embedding", lambda x: x != 0)
    return vectors.where(F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)) & other_than_zero)


def classes(vectors: DataFrame) -> DataFrame:
    """``node`` (hash of the vector), ``low`` (smallest id), ``weight``, ``embedding`` of each distinct usable vector."""
    distinct = usable(vectors).groupBy("embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("weight"))
    return distinct.select(F.xxhash64("embedding").alias("node"), "low", "weight", "embedding")


def met(distinct: DataFrame, vectors: int, cosine: float) -> DataFrame:
    """A row for each class and table, and for each block pair of a hot cell."""

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                part = whole.slice(start, 2000)
                sizes = np.diff(np.asarray(part.column(2).offsets))
                for size in np.unique(sizes):
                    batch = part.take(pa.array(np.flatnonzero(sizes == size)))
                    lines = Projections.calibrated(int(size), vectors, cosine)
                    cells = lines.cells(unit_vectors(batch.column(2)))
                    row = pa.array(np.repeat(np.arange(batch.num_rows), lines.tables))
                    table = np.tile(np.arange(lines.tables, dtype=np.int32), batch.num_rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells.ravel()), pa.array(table), *batch.take(row).columns],
                        ["cell", "table_no", "node", "weight", "embedding"],
                    )

    kind = dict(distinct.dtypes)["embedding"]
    schema = f"cell long, table_no int, node long, weight long, embedding {kind}"
    rows = distinct.select("node", "weight", "embedding").mapInArrow(run, schema)
    return rows


def linked(rows: DataFrame, vectors: int, cosine: float) -> DataFrame:
    """``a, b, links``: forest edges (links 0), and for each class its links (b null)."""
    distance = sqrt(2 - 2 * cosine)
    count = needed_count(distance)
    sizes = store(rows.groupBy("cell").count().where("count > 1"), "vector-cells")
    placed = rows.join(sizes, "cell")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    paired = placed.withColumn("blocks", blocks).withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    dealt = paired.select(
        "cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "table_no", "node", "weight", "embedding",
    )

    def pairs_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Links among the rows of whole groups, which follow each other."""
        cell, low, high, block, table, node, weight = (np.asarray(batch.column(at)) for at in range(7))
        units = unit_vectors(batch.column(7))
        lines = Projections.calibrated(units.shape[1], vectors, cosine)
        cells = lines.cells(units)
        projected = units @ lines.drawn[2]
        change = (cell[1:] != cell[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        group = np.concatenate([[0], np.cumsum(change)])
        left = np.bincount(group)[group] - (np.arange(len(group)) - np.searchsorted(group, group))
        firsts, seconds = [], []
        step, at = 1, np.flatnonzero(left > 1)
        while len(at):
            for part in np.array_split(at, len(at) // 50_000 + 1):
                other = part + step
                fresh = (block[part] != block[other]) | (low[part] == high[part])
                i, j = part[fresh], other[fresh]
                before = np.arange(lines.tables) < table[i][:, None]
                new = ~((cells[i] == cells[j]) & before).any(axis=1)
                i, j = i[new], j[new]
                collisions = (np.abs(projected[i] - projected[j]) <= WINDOW).sum(axis=1)
                i, j = i[collisions >= count], j[collisions >= count]
                close = np.einsum("ij,ij->i", units[i], units[j]) >= cosine
                firsts.append(i[close])
                seconds.append(j[close])
            step += 1
            at = at[left[at] > step]
        i, j = np.concatenate([*firsts, np.zeros(0, int)]), np.concatenate([*seconds, np.zeros(0, int)])
        links = np.zeros(len(node), np.int64)
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        root = np.arange(len(node))
        while True:  # each row takes the first row in reach
            least = np.minimum(root[i], root[j])
            now = root.copy()
            np.minimum.at(now, i, least)
            np.minimum.at(now, j, least)
            now = now[now]
            if (now == root).all():
                break
            root = now
        has, hung = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(node)))
        a = np.concatenate([node[has], node[hung]])
        b = pa.concat_arrays([pa.nulls(len(has), pa.int64()), pa.array(node[root[hung]])])
        return pa.RecordBatch.from_arrays(
            [pa.array(a), b, pa.array(np.concatenate([links[has], np.zeros(len(hung), np.int64)]))], ["a", "b", "links"]
        )

    def by_length(batch: pa.RecordBatch) -> Batches:
        sizes = np.diff(np.asarray(batch.column(7).offsets))
        for size in np.unique(sizes):
            yield pairs_of(batch.take(pa.array(np.flatnonzero(sizes == size))))

    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []
        rows_held = 0
        for whole in batches:
            for start in range(0, whole.num_rows, 4000):
                held.append(whole.slice(start, 4000))
                rows_held += held[-1].num_rows
                if rows_held < 8000:
                    continue
                table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                key = [np.asarray(table.column(at)) for at in range(3)]
                same = (key[0] == key[0][-1]) & (key[1] == key[1][-1]) & (key[2] == key[2][-1])
                cut = int(np.argmax(same))  # the last group may go on in the next batch
                if cut:
                    yield from by_length(table.slice(0, cut))
                held, rows_held = [table.slice(cut)], table.num_rows - cut
        if rows_held:
            yield from by_length(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    ordered = dealt.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
    return ordered.mapInArrow(run, "a long, b long, links long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector."""
    distinct = store(classes(vectors), "vector-classes")
    number = distinct.count()
    found = store(linked(met(distinct, number, cosine), number, cosine), "vector-links")
    groups = components(found.where("b is not null").select("a", "b"))
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    grouped = distinct.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = grouped.groupBy("component").agg(F.min("low").alias("component_id"))
    of_class = (
        grouped.join(links, "node", "left")
        .join(lowest, "component")
        .select(
            F.col("embedding").alias("of"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            "component_id",
        )
    )
    # Unusable vectors have no class: their component is their own id.
    labelled = vectors.select("vec_id", "embedding").join(of_class, F.col("embedding") == F.col("of"), "left")
    component = F.coalesce("component_id", "vec_id")
    return labelled.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
