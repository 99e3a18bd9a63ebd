"""Logistic regression on a few numeric columns by iteratively reweighted least squares.

Every step is one aggregate over the rows: the entries of X'WX and X'Wz, a handful of sums. The system of a
few unknowns is solved on the driver. Minimises ``C * sum(s * log loss) + |w|^2 / 2`` with a free intercept, the
objective of the classifier over TF-IDF weights.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrain.fixed_values import LOGISTIC_C
from lexigrain.operators.models import balanced_weights, class_sizes, sigmoid

INTERCEPT = "intercept"
STEPS = 8


def fit_reweighted(
    frame: DataFrame,
    columns: Sequence[str],
    label: str = "target",
    c: float = LOGISTIC_C,
    steps: int = STEPS,
    tolerance: float = 0.0,
    balanced: bool = True,
) -> dict[str, float]:
    """Coefficients by column name after at most ``steps`` steps from zero; ``frame`` should be stored.

    Stops early when no coefficient moves by more than ``tolerance``. Rows with a null in a column
    or in the label are left out.
    """
    rows = frame.select(F.col(label).cast("int").alias("target"), *[F.col(name).cast("double").alias(name) for name in columns]).na.drop()
    share = balanced_weights(class_sizes(rows)) if balanced else F.lit(1.0)
    design: list[Column] = [F.lit(1.0), *[F.col(name) for name in columns]]
    size = len(design)
    penalty = np.diag([0.0] + [1.0] * len(columns))
    point = np.zeros(size)
    for _ in range(steps):
        line = sum((x * float(b) for x, b in zip(design[1:], point[1:])), F.lit(float(point[0])))
        held = rows.withColumns({"_share": share, "_line": line}).withColumn("_p", sigmoid(F.col("_line")))
        curve = F.col("_share") * F.col("_p") * (1 - F.col("_p"))
        pull = curve * F.col("_line") + F.col("_share") * (F.col("target") - F.col("_p"))
        sums = held.agg(
            *[F.sum(curve * design[i] * design[j]).alias(f"h{i}_{j}") for i in range(size) for j in range(i, size)],
            *[F.sum(pull * design[i]).alias(f"g{i}") for i in range(size)],
        ).first()
        matrix = np.array([[sums[f"h{min(i, j)}_{max(i, j)}"] for j in range(size)] for i in range(size)])
        solved = np.linalg.solve(penalty + c * matrix, c * np.array([sums[f"g{i}"] for i in range(size)]))
        moved = np.abs(solved - point).max()
        point = solved
        if moved <= tolerance:
            break
    return dict(zip([INTERCEPT, *columns], point.tolist()))
