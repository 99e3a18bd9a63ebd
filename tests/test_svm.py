"""The squared-hinge solver and its calibration against plain numpy, folds and splits with repeated ids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrain.fixed_values import SVM_C
from lexigrain.operators import svm
from lexigrain.operators.models import fit_svm
from lexigrain.operators.split import TEST, stratified_folds, stratified_split

ENTRY = "array<struct<i:int,w:double>>"


def sparse_rows(seed=0, rows=240, size=40):
    draw = np.random.default_rng(seed)
    out = []
    for at in range(rows):
        target = int(draw.random() < 0.35)
        known = draw.choice(size, draw.integers(0, 9), replace=False)
        values = draw.random(len(known)) + 0.5 * (known % 3 == target)
        norm = np.sqrt((values**2).sum()) or 1.0
        out.append((at, target, [(int(i), float(v / norm)) for i, v in sorted(zip(known, values))], at % 3))
    return out


def dense(rows, size):
    x = np.zeros((len(rows), size + 1))
    x[:, -1] = 1
    for at, (_, _, entries, _) in enumerate(rows):
        for i, w in entries:
            x[at, i] = w
    return x, np.array([1.0 if target else -1.0 for _, target, _, _ in rows])


def plain_svm(x, y, share, c):
    """Newton steps with the full Hessian until nothing moves."""
    w = np.zeros(x.shape[1])

    def value(w):
        return w @ w / 2 + c * (share * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()

    for _ in range(200):
        slack = 1 - y * (x @ w)
        on = slack > 0
        gradient = w - 2 * c * x.T @ (share * on * y * slack)
        step = -np.linalg.solve(np.eye(len(w)) + 2 * c * (x.T * (share * on)) @ x, gradient)
        t = 1.0
        while value(w + t * step) > value(w) and t > 1e-12:
            t /= 2
        w = w + t * step
        if np.abs(step).max() < 1e-12:
            break
    return w


def plain_sigmoid(margins, targets):
    n1, n0 = targets.sum(), (1 - targets).sum()
    goal = np.where(targets == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    point = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(500):
        share = 1 / (1 + np.exp(-(point[0] * margins + point[1])))
        design = np.stack([margins, np.ones_like(margins)])
        gradient = design @ (share - goal)
        curve = (design * share * (1 - share)) @ design.T
        step = np.linalg.solve(curve + 1e-12 * np.eye(2), gradient)
        point = point - np.clip(step, -1, 1)
    return point


def balanced(y):
    return np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))


@pytest.mark.parametrize("c", [0.05, SVM_C, 20.0])
def test_solver_equals_numpy(spark, c):
    rows, size = sparse_rows(), 40
    frame = spark.createDataFrame(rows, f"id long, target int, weights {ENTRY}, fold int")
    x, y = dense(rows, size)
    fold = np.array([row[3] for row in rows])
    balance = {}
    for k in (-1, 0, 1, 2):
        share = balanced(y[fold != k])
        balance[k] = (share[y[fold != k] < 0][0], share[y[fold != k] > 0][0])
    found = svm.fit_leaving_out(frame, size, [-1, 0, 1, 2], balance, c, 1e-6, 1000)
    for k, weights in found.items():
        plain = plain_svm(x[fold != k], y[fold != k], balanced(y[fold != k]), c)
        assert np.abs(weights - plain).max() < 1e-5


def test_blocks_give_the_same_sums(spark, monkeypatch):
    rows = sparse_rows(4, 90)
    frame = spark.createDataFrame(rows, f"id long, target int, weights {ENTRY}, fold int").coalesce(2)
    balance = {-1: (1.0, 2.0)}
    whole = svm.fit_leaving_out(frame, 40, [-1], balance, 1.0, 1e-7, 100)[-1]
    monkeypatch.setattr(svm, "BLOCK_ENTRIES", 30)
    monkeypatch.setattr(svm, "BLOCK_SUMS", 7)
    monkeypatch.setattr(svm, "COLLECTED_BYTES", 0)
    assert np.abs(svm.fit_leaving_out(frame, 40, [-1], balance, 1.0, 1e-7, 100)[-1] - whole).max() < 1e-6


def test_what_a_pass_collects_does_not_grow_with_the_tasks(spark, monkeypatch):
    size, collected = 40_000, []
    frame = spark.createDataFrame(sparse_rows(2, 64), f"id long, target int, weights {ENTRY}, fold int").repartition(8)
    collect = type(frame).toArrow

    def counted(part):
        found = collect(part)
        collected.append(found.nbytes)
        return found

    monkeypatch.setattr(type(frame), "toArrow", counted)
    svm._pass(frame.select("weights", "target", "fold"), 8, size, {-1: svm.Query(np.zeros(size + 1))}, {-1: (1.0, 1.0)})
    assert len(collected) == 1 and collected[0] < 1.1 * (2 * size + 3) * 8


def test_packing_keeps_rows_entries_and_labels(spark, monkeypatch):
    monkeypatch.setattr(svm, "BLOCK_ENTRIES", 16)
    long = [(i, 0.5 + i) for i in range(40)]
    rows = [(1, [(3, 0.25), (7, 1.0)], 0), (0, [], 0), (None, [(0, 2.0)], 0), (1, None, 2), (0, long, 2), (1, [(5, 3.0)], 2), (1, [], 1)]
    frame = spark.createDataFrame([(w, t, k) for t, w, k in rows], f"weights {ENTRY}, target int, fold int").coalesce(1)
    blocks = svm.packed(frame)
    assert svm.packed(blocks) is blocks
    found = []
    for block in blocks.collect():
        sizes, index, values = (np.frombuffer(part, kind) for part, kind in ((block["sizes"], np.int32), (block["index"], np.int32), (block["values"], float)))
        ends = np.cumsum(sizes)
        assert len(sizes) == len(block.target) and ends[-1] == len(index) == len(values)
        for target, start, end in zip(block.target, ends - sizes, ends):
            found.append((target, list(zip(index[start:end].tolist(), values[start:end].tolist())), block.fold))
    assert sorted(map(repr, found)) == sorted(repr((t, w or [], k)) for t, w, k in rows)
    fitted = {k: np.arange(41.0) + k for k in range(3)}
    margins = svm.margins_left_out(blocks, fitted).collect()
    wanted = [(k, t, float(sum(v * (i + k) for i, v in w or []) + 40 + k)) for t, w, k in rows]
    assert sorted(map(repr, map(tuple, margins))) == sorted(map(repr, wanted))


def test_a_fit_takes_few_passes():
    # Common and rare features that often stand together, as words do.
    draw = np.random.default_rng(3)
    topics = draw.random((6, 300)) ** 8 / np.arange(1, 301) ** 0.7
    x = (draw.random((3000, 300)) < 12 * topics[draw.integers(0, 6, 3000)]) * (1 + draw.random((3000, 300)))
    x = np.hstack([x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1), np.ones((3000, 1))])
    y = np.where(x @ draw.normal(size=301) + draw.normal(size=3000) > 0, 1.0, -1.0)
    solver, passes = svm.newton_steps(300, 1.0, 1e-3, 100), 0
    asked = next(solver)
    while True:
        passes += 1
        slack = 1 - y * (x @ asked.weights)
        on = 2.0 * (slack > 0)
        if asked.direction is None:
            sums = svm.Sums(x.T @ (-on * y * slack), (x * x).T @ on, float((np.maximum(slack, 0) ** 2).sum()))
        else:
            sums = svm.Sums(x.T @ (on * (x @ asked.direction)), np.zeros(0), 0.0)
        try:
            asked = solver.send(sums)
        except StopIteration as done:
            weights = done.value
            break
    assert np.abs(weights - plain_svm(x, y, np.ones(3000), 1.0)).max() < 1e-3
    # 87 where a direction was conjugate to the last one only and every Newton step began anew.
    assert passes < 60


def test_a_pass_leaves_settings_as_they_were(spark):
    frame = spark.createDataFrame(sparse_rows(2, 64), f"id long, target int, weights {ENTRY}, fold int")
    before = {key: spark.conf.get(key, None) for key in svm._SETTINGS}
    svm._pass(frame, 8, 40, {-1: svm.Query(np.zeros(41))}, {-1: (1.0, 1.0)})
    assert {key: spark.conf.get(key, None) for key in svm._SETTINGS} == before


def test_sigmoids_equal_numpy(spark):
    draw = np.random.default_rng(5)
    rows = [(k, int(t), float(draw.normal() + (2 * t - 1) * k)) for k in (0, 1, 2) for t in draw.integers(0, 2, 150)]
    rows += [(3, t, float(2 * t - 1)) for t in (0, 1) for _ in range(20)]  # separable
    found = svm.fit_sigmoids(spark.createDataFrame(rows, "fold int, target int, margin double"))
    for k, point in found.items():
        margins, targets = (np.array([row[at] for row in rows if row[0] == k]) for at in (2, 1))
        assert point == pytest.approx(plain_sigmoid(margins, targets).tolist(), abs=1e-5)
    with pytest.raises(ValueError, match="both classes"):
        svm.fit_sigmoids(spark.createDataFrame([(0, 1, 0.5)], "fold int, target int, margin double"))


def test_fitted_model_is_the_mean_of_calibrated_folds(spark):
    rows, size = sparse_rows(2, 300), 40
    frame = spark.createDataFrame([row[:3] for row in rows], f"id long, target int, weights {ENTRY}")
    model = fit_svm(frame, size)
    folds = {r.id: r.fold for r in stratified_folds(frame, 3).collect()}
    x, y = dense(rows, size)
    fold = np.array([folds[row[0]] for row in rows])
    wanted = np.zeros(len(rows))
    for k, score in enumerate(model.scores):
        learns = fold != k
        w = plain_svm(x[learns], y[learns], balanced(y[learns]), SVM_C)
        slope, offset = plain_sigmoid(x[~learns] @ w, (y[~learns] > 0).astype(float))
        wanted += 1 / (1 + np.exp(-(slope * (x @ w) + offset))) / 3
        assert np.abs(np.append(score.coefficients, score.intercept) - w).max() < 1e-3
    found = frame.select("id", model.probability(F.col("weights")).alias("p")).orderBy("id").collect()
    assert np.abs(np.array([r.p for r in found]) - wanted).max() < 1e-3


def test_folds_are_stratified(spark):
    frame = spark.range(1000).select("id", (F.col("id") % 7 == 0).cast("int").alias("target"))
    counts = {(r.fold, r.target): r["count"] for r in stratified_folds(frame, 3).groupBy("fold", "target").count().collect()}
    for label, n in ((0, 857), (1, 143)):
        sizes = [counts[k, label] for k in range(3)]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def parts(split):
    return {(r.split, r.target): r["count"] for r in split.groupBy("split", "target").count().collect()}


def test_quota_ends_inside_a_repeated_id(spark):
    # One id on a third of the rows; some rows differ in their text, many are equal in every column.
    ids = F.when(F.col("n") % 3 == 0, F.lit(5)).otherwise(F.col("n"))
    text = F.concat(F.lit("t"), (F.col("n") % 90).cast("string"))
    frame = spark.range(3000).select(F.col("id").alias("n")).select(ids.alias("id"), text.alias("text"), (F.col("n") % 2).cast("int").alias("target"))
    for seed in range(12):  # the repeated id falls into the test part, the training part, or across the cut
        split = stratified_split(frame, seed=seed)
        assert parts(split) == {(TEST, 0): 300, (TEST, 1): 300, ("train", 0): 1200, ("train", 1): 1200}
    assert split.select("id", "text", "target").exceptAll(frame).isEmpty() and frame.exceptAll(split.drop("split")).isEmpty()
    again = stratified_split(frame, seed=11)
    assert split.exceptAll(again).isEmpty()


@pytest.mark.parametrize("share", [0.2, 0.0, 1.0])
def test_quota_of_equal_rows_and_null_ids(spark, share):
    equal = spark.range(10_000).select(F.lit(None).cast("long").alias("id"), F.lit("same").alias("text"), (F.col("id") % 2).cast("int").alias("target"))
    found = parts(stratified_split(equal, share))
    assert sum(n for (split, _), n in found.items() if split == TEST) == round(10_000 * share)
    assert sum(found.values()) == 10_000
    assert stratified_split(equal.limit(0)).count() == 0
