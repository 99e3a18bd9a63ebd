"""Linear support vectors with squared hinge loss, by distributed truncated Newton steps.

Minimises ``|w|^2 / 2 + C * sum(s * max(0, 1 - y * w.x)^2)`` with the intercept as the weight of a constant
feature. The rows are written once as blocks of plain arrays, each of one fold. Every pass over them is one
Spark job: tasks multiply their sparse rows with
the current vectors and add up gradients or Hessian products; beyond a few, the sums of tasks are added by
block of features in a shuffle; a few numbers per feature of a bounded vocabulary come back. Several problems that
leave out one fold each are solved in step, so a pass serves them all.

The objective is strongly convex with modulus 1, so a gradient of length ``tolerance`` proves that the
weights are within ``tolerance`` of the optimum.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrain.session import stored

#: Rows are stored and multiplied in blocks of about so many entries, which the processor's cache holds.
BLOCK_ENTRIES = 1 << 15
#: Blocks in the store: the entries of all rows one after another, ``sizes`` of them to a row.
_PACKED = "fold int, target array<int>, sizes binary, index binary, values binary"
_NAMES = [column.split()[0] for column in _PACKED.split(", ")]
#: A row of the store is a block, so pages and row groups are cut by size at every row.
_STORE = {
    "compression": "none", "parquet.enable.dictionary": "false", "parquet.block.size": str(16 << 20),
    "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1",
}
#: Directions of earlier Newton steps that are kept for each problem.
DIRECTIONS_KEPT = 64
#: Sums that travel as one value, and how much of them may come back unadded in a pass.
BLOCK_SUMS = 1024
COLLECTED_BYTES = 4 << 20
_SUMS = "problem int, block int, sums binary"
#: Settings of a pass. It deletes its shuffle files when it ends; else those of all passes would stay until the driver collects
#: its garbage. Blocks go to Python a few MiB at a time, which is faster than the tens of MiB that are usual.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


@dataclass(frozen=True)
class Query:
    """What a problem asks of the next pass: its gradient at ``weights``, or the Hessian there times ``direction``."""

    weights: np.ndarray
    direction: np.ndarray | None = None


@dataclass(frozen=True)
class Sums:
    vector: np.ndarray
    diagonal: np.ndarray
    loss: float


def packed(rows: DataFrame) -> DataFrame:
    """``weights, target, fold`` rows, stored as blocks of rows of one fold; blocks stay as they are."""
    if rows.columns == _NAMES:
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds = np.asarray(batch.column(2))
            for fold in np.unique(folds).tolist():
                own = batch.filter(pa.array(folds == fold))
                column, target = own.column(0), own.column(1)
                at = np.asarray(column.offsets)
                entries = column.values
                index, values = np.asarray(entries.field(0), np.int32), np.asarray(entries.field(1), np.float64)
                bounds = [*np.flatnonzero(np.diff((at[:-1] - at[0]) // BLOCK_ENTRIES, prepend=-1)).tolist(), len(own)]
                parts = list(zip(bounds, bounds[1:]))
                arrays = [
                    [np.diff(at[start : end + 1]).astype(np.int32) for start, end in parts],
                    *[[data[at[start] : at[end]] for start, end in parts] for data in (index, values)],
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([fold] * len(parts), pa.int32()),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), target),
                        *[pa.array([data.tobytes() for data in column], pa.binary()) for column in arrays],
                    ],
                    _NAMES,
                )

    return stored(rows.select("weights", "target", "fold").mapInArrow(run, _PACKED), "packed", **_STORE)


class _Block:
    """Sparse rows as flat arrays. ``space`` lends the arrays of one block to the next: new ones cost more than the sums."""

    def __init__(self, sizes: np.ndarray, index: np.ndarray, values: np.ndarray, space: list[np.ndarray]) -> None:
        if not space or len(space[0]) < len(index):
            space[:] = np.empty(len(index), np.int64), np.empty(len(index), np.int64), np.empty(len(index))
        self.index, self.row, self.product = (array[: len(index)] for array in space)
        self.rows, self.values = len(sizes), values
        self.filled = np.flatnonzero(sizes)
        self.starts = (np.cumsum(sizes) - sizes)[self.filled]
        self.index[:] = index
        # The place of an entry's row among those that have any.
        self.row[:] = 0
        self.row[self.starts[1:]] = 1
        np.cumsum(self.row, out=self.row)

    def times(self, vector: np.ndarray) -> np.ndarray:
        """The rows times a vector, the last place of which is that of the constant feature."""
        out = np.full(self.rows, vector[-1])
        if len(self.filled):
            np.take(vector, self.index, out=self.product, mode="clip")
            np.multiply(self.product, self.values, out=self.product)
            out[self.filled] += np.add.reduceat(self.product, self.starts)
        return out

    def add_columns(self, total: np.ndarray, factor: np.ndarray, power: int = 1) -> None:
        """Add to ``total`` the rows (or squares of their entries), each times its factor."""
        if len(self.filled):
            np.take(factor[self.filled], self.row, out=self.product, mode="clip")
            for _ in range(power):
                np.multiply(self.product, self.values, out=self.product)
            np.add.at(total, self.index, self.product)
        total[-1] += factor.sum()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, _Block]]:
    """Fold, labels and rows of each block, which is valid until the next is asked for."""
    space: list[np.ndarray] = []
    for batch in batches:
        for at in range(batch.num_rows):
            fold, target, *data = (column[at] for column in batch.columns)
            arrays = [np.frombuffer(part.as_buffer(), kind) for part, kind in zip(data, (np.int32, np.int32, np.float64))]
            yield fold.as_py(), target.values, _Block(*arrays, space)


class _Totals:
    """Sums of one task for one problem; the last place is that of the constant feature."""

    def __init__(self, size: int, query: Query, balance: tuple[float, float]) -> None:
        self.query, self.balance = query, balance
        self.vector = np.zeros(size + 1)
        self.diagonal = np.zeros(size + 1)
        self.loss = 0.0

    def add(self, block: _Block, sign: np.ndarray) -> None:
        slack = 1 - sign * block.times(self.query.weights)
        share = np.where(sign > 0, self.balance[1], self.balance[0]) * (slack > 0)
        if self.query.direction is None:
            factor = -2 * share * sign * slack
            self.loss += float(share @ (slack * slack))
            block.add_columns(self.diagonal, 2 * share, power=2)
        else:
            factor = 2 * share * block.times(self.query.direction)
        block.add_columns(self.vector, factor)

    def sums(self) -> np.ndarray:
        """All sums in a row: the vector and, for a gradient, the diagonal and the loss."""
        if self.query.direction is not None:
            return self.vector
        return np.concatenate([self.vector, self.diagonal, [self.loss]])


def _sum_rows(sums: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    """``problem, block, sums`` rows."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([problem for problem, _ in sums], pa.int32()),
            pa.array([block for _, block in sums], pa.int32()),
            pa.array([values.tobytes() for values in sums.values()], pa.binary()),
        ],
        ["problem", "block", "sums"],
    )


def _added(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], np.ndarray]:
    out: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for problem, block, data in zip(*[column.to_pylist() for column in batch.columns]):
            values = np.frombuffer(data)
            out[problem, block] = out[problem, block] + values if (problem, block) in out else values
    return out


@contextmanager
def _settings_of_a_pass(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _pass(
    rows: DataFrame, tasks: int, size: int, asked: dict[int, Query], balance: dict[int, tuple[float, float]]
) -> dict[int, Sums]:
    """Sums for every asked problem; problem k learns from all folds but k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: _Totals(size, query, balance[k]) for k, query in asked.items()}
        for fold, target, block in _blocks(batches):
            sign = np.where(np.asarray(target) == 1, 1.0, -1.0)
            for k, total in totals.items():
                if k != fold:
                    total.add(block, sign)
        parts = {}
        for k, total in totals.items():
            values = total.sums()
            for block, at in enumerate(range(0, len(values), BLOCK_SUMS)):
                parts[k, block] = values[at : at + BLOCK_SUMS]
        yield _sum_rows(parts)

    blocks = packed(rows)
    with _settings_of_a_pass(rows.sparkSession):
        partial = blocks.mapInArrow(run, _SUMS)
        # Sums of a few tasks over few features come straight back, others are added up by block on the way: what
        # comes back does not grow with the tasks.
        if tasks > 1 and tasks * len(asked) * (2 * size + 3) * 8 > COLLECTED_BYTES:
            cores = rows.sparkSession.sparkContext.defaultParallelism
            dealt = partial.repartition(cores, "problem", "block")
            partial = dealt.mapInArrow(lambda batches: iter([_sum_rows(_added(batches))]), _SUMS)
        found = _added(partial.toArrow().to_batches())
    out = {}
    for k, query in asked.items():
        values = np.concatenate([found[key] for key in sorted(key for key in found if key[0] == k)])
        if query.direction is not None:
            out[k] = Sums(values, np.zeros(0), 0.0)
        else:
            out[k] = Sums(values[: size + 1], values[size + 1 : -1], float(values[-1]))
    return out


#: Directions of a Newton step (rows), what the Hessian makes of them, both in single precision, and their lengths in it.
_Seen = tuple[np.ndarray, np.ndarray, np.ndarray]


def _preconditioned(rest: np.ndarray, diagonal: np.ndarray, seen: Sequence[_Seen]) -> np.ndarray:
    """About the inverse Hessian times ``rest``: by the directions seen before, else by the diagonal."""
    if not seen:
        return rest / diagonal
    *earlier, (directions, products, lengths) = seen
    along = (directions @ rest.astype(np.float32)) / lengths
    other = _preconditioned(rest - along.astype(np.float32) @ products, diagonal, earlier)
    return other + (along - (products @ other.astype(np.float32)) / lengths).astype(np.float32) @ directions


def newton_steps(
    size: int, c: float, tolerance: float, max_iterations: int, max_inner: int = 100,
    seen: list[_Seen] | None = None, kept: int = DIRECTIONS_KEPT,
) -> Generator[Query, Sums, np.ndarray]:
    """One problem's solver: yields what it asks of the data and returns weights with the intercept last.

    Newton directions come from conjugate gradients, stopped early while the gradient is large; steps are
    halved until the objective falls enough. Every product costs a pass, so none is wasted: a direction is made
    conjugate to all before it, and the Hessian changes little from step to step, so the directions of earlier
    steps precondition the next, over the Hessian's diagonal (block BFGS update). Problems over much the same
    rows may share the list ``seen`` of such directions, ``kept`` at most in all but one step.
    """

    def at(weights: np.ndarray) -> Generator[Query, Sums, tuple[float, np.ndarray, np.ndarray]]:
        sums = yield Query(weights)
        return weights @ weights / 2 + c * sums.loss, weights + c * sums.vector, 1 + c * sums.diagonal

    weights = np.zeros(size + 1)
    value, gradient, diagonal = yield from at(weights)
    seen = [] if seen is None else seen
    for _ in range(max_iterations):
        length = np.linalg.norm(gradient)
        if length <= tolerance:
            break
        wanted = max(tolerance / 2, length / 10)
        step, rest = np.zeros(size + 1), -gradient
        directions, products, lengths = np.empty((max_inner, size + 1)), np.empty((max_inner, size + 1)), np.empty(max_inner)
        n, before = 0, list(seen)
        while n < max_inner and np.linalg.norm(rest) > wanted:
            direction = _preconditioned(rest, diagonal, before)
            direction = direction - ((products[:n] @ direction) / lengths[:n]) @ directions[:n]
            sums = yield Query(weights, direction)
            curved = direction + c * sums.vector
            directions[n], products[n], lengths[n] = direction, curved, direction @ curved
            length_of_step = (direction @ rest) / lengths[n]
            step += length_of_step * direction
            rest = rest - length_of_step * curved
            n += 1
        if n:
            seen.append((directions[:n].astype(np.float32), products[:n].astype(np.float32), lengths[:n].copy()))
        del directions, products  # before those of the next step are made
        while len(seen) > 1 and sum(len(lengths) for _, _, lengths in seen) > kept:
            del seen[0]
        slope, size_of_step = gradient @ step, 1.0
        for _ in range(40):
            candidate = weights + size_of_step * step
            new = yield from at(candidate)
            if new[0] <= value + 1e-4 * size_of_step * slope + 1e-12 * abs(value):
                break
            size_of_step /= 2
        else:
            break
        weights, (value, gradient, diagonal) = candidate, new
    return weights


def fit_leaving_out(
    rows: DataFrame,
    size: int,
    problems: Sequence[int],
    balance: dict[int, tuple[float, float]],
    c: float,
    tolerance: float,
    max_iterations: int,
) -> dict[int, np.ndarray]:
    """Weights (intercept last) for every problem k, learned from the ``weights, target, fold`` rows (or blocks of them) of all folds but k.

    ``balance`` holds the weights of class 0 and 1 for each problem. A problem that no fold has (-1) learns from all rows.
    """
    # Problems share most rows, so the directions of one serve all as preconditioners.
    seen: list[_Seen] = []
    kept = DIRECTIONS_KEPT * len(problems)
    solvers = {k: newton_steps(size, c, tolerance, max_iterations, seen=seen, kept=kept) for k in problems}
    asked = {k: next(solver) for k, solver in solvers.items()}
    rows = packed(rows)
    # A task for each core: sums are as many as the cores, not as the files, and starting a task takes as long as millions of entries.
    tasks = max(1, min(rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism))
    rows = rows.coalesce(tasks)
    solved: dict[int, np.ndarray] = {}
    while asked:
        following = {}
        for k, sums in _pass(rows, tasks, size, asked, balance).items():
            try:
                following[k] = solvers[k].send(sums)
            except StopIteration as done:
                solved[k] = done.value
        asked = following
    return solved


def margins_left_out(blocks: DataFrame, fitted: dict[int, np.ndarray]) -> DataFrame:
    """``fold, target, margin`` of the rows of blocks, by the weights that did not learn from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fold, target, block in _blocks(batches):
            folds = pa.array(np.full(len(target), fold, np.int32))
            yield pa.RecordBatch.from_arrays([folds, target, pa.array(block.times(fitted[fold]))], ["fold", "target", "margin"])

    return blocks.mapInArrow(run, "fold int, target int, margin double")


def fit_sigmoids(margins: DataFrame, max_iterations: int = 100, tolerance: float = 1e-9) -> dict[int, tuple[float, float]]:
    """Per fold the slope and offset of a sigmoid through ``fold, target, margin`` rows, with Platt's soft targets.

    Newton steps in two unknowns; a step is one aggregation by fold for all folds together.
    """
    sizes = {
        row.fold: (row.n0, row.n1)
        for row in margins.groupBy("fold").agg(F.count_if(F.col("target") == 0).alias("n0"), F.count_if(F.col("target") == 1).alias("n1")).collect()
    }
    if any(min(pair) == 0 for pair in sizes.values()):
        raise ValueError("calibration needs rows of both classes in every fold")

    def by_fold(values: dict[int, float]):
        out = F.lit(0.0)
        for fold, value in values.items():
            out = F.when(F.col("fold") == fold, F.lit(float(value))).otherwise(out)
        return out

    high = by_fold({k: (n1 + 1) / (n1 + 2) for k, (_, n1) in sizes.items()})
    low = by_fold({k: 1 / (n0 + 2) for k, (n0, _) in sizes.items()})
    rows = margins.withColumn("goal", F.when(F.col("target") == 1, high).otherwise(low))

    def sums(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
        line = by_fold({k: p[0] for k, p in points.items()}) * F.col("margin") + by_fold({k: p[1] for k, p in points.items()})
        share, m = 1 / (1 + F.exp(-F.col("line"))), F.col("margin")
        # log(1 + e^line) - goal * line, without overflow.
        loss = F.greatest("line", F.lit(0.0)) + F.log1p(F.exp(-F.abs("line"))) - F.col("goal") * F.col("line")
        found = rows.withColumn("line", line).groupBy("fold").agg(
            F.sum(loss).alias("loss"), F.sum((share - F.col("goal")) * m).alias("ga"), F.sum(share - F.col("goal")).alias("gb"),
            F.sum(share * (1 - share) * m * m).alias("aa"), F.sum(share * (1 - share) * m).alias("ab"), F.sum(share * (1 - share)).alias("bb"),
        )
        return {r.fold: (r.loss, np.array([r.ga, r.gb]), np.array([[r.aa, r.ab], [r.ab, r.bb]])) for r in found.collect()}

    points = {k: np.array([0.0, math.log((n1 + 1) / (n0 + 1))]) for k, (n0, n1) in sizes.items()}
    state = sums(points)
    open_folds = set(points)
    steps: dict[int, np.ndarray] = {}
    for _ in range(max_iterations):
        for k in open_folds - steps.keys():
            _, gradient, curve = state[k]
            steps[k] = -np.linalg.solve(curve + 1e-12 * np.eye(2), gradient)
        moved = {k: points[k] + steps[k] if k in open_folds else points[k] for k in points}
        found = sums(moved)
        for k in list(open_folds):
            if found[k][0] <= state[k][0] + 1e-12 * abs(state[k][0]):
                small = np.abs(steps[k]).max() <= tolerance * max(1.0, np.abs(moved[k]).max())
                points[k], state[k] = moved[k], found[k]
                del steps[k]
                if small:
                    open_folds.discard(k)
            else:
                steps[k] = steps[k] / 2
        if not open_folds:
            break
    return {k: (float(p[0]), float(p[1])) for k, p in points.items()}
