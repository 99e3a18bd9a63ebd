"""Classifiers over TF-IDF weights.

Training uses Spark ML where the fit is iterative and plain aggregation where it is
not. A fitted model is a coefficient per term, so scoring is a narrow expression over
the weights of a row and runs alike on tables and streams.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrain.fixed_values import (
    BASELINE_MODEL,
    CALIBRATION_FOLDS,
    DECISION_THRESHOLD,
    LABELS,
    LOGISTIC_C,
    LOGISTIC_MODEL,
    MAX_ITERATIONS,
    NAIVE_BAYES_MODEL,
    NAIVE_BAYES_SMOOTHING,
    SEED,
    SVM_C,
    SVM_MODEL,
)
from lexigrain.functions.expressions import bind, literal_array
from lexigrain.operators import svm
from lexigrain.operators.split import stratified_folds
from lexigrain.operators.tfidf import TfidfModel, entries_of, sparse_vector
from lexigrain.session import materialise, stored

TOLERANCE = 1e-5
#: Largest distance of the SVM's weights from the optimum.
SVM_TOLERANCE = 1e-3


def sigmoid(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


@dataclass(frozen=True)
class LinearScore:
    """One linear function of the weights, with an optional sigmoid calibration."""

    coefficients: Sequence[float]
    intercept: float = 0.0
    numeric_coefficient: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, weights: Column, numeric: Column | None = None) -> Column:
        table = literal_array(self.coefficients)
        margin = F.aggregate(
            weights,
            F.lit(0.0),
            lambda total, entry: total + entry["w"] * F.get(table, entry["i"]),
        ) + F.lit(self.intercept)
        if numeric is not None and self.numeric_coefficient:
            margin = margin + numeric * self.numeric_coefficient
        return sigmoid(margin * self.slope + self.offset)


@dataclass(frozen=True)
class FittedModel:
    """A classifier: the mean of its scores, or a constant when it has none."""

    name: str
    scores: Sequence[LinearScore] = ()
    constant: float = 0.0
    uses_numeric: bool = False
    numeric_mean: float = 0.0
    numeric_std: float = 1.0
    parameters: dict = field(default_factory=dict)

    def probability(self, weights: Column, numeric: Column | None = None) -> Column:
        if not self.scores:
            return F.lit(float(self.constant))
        scaled = None
        if self.uses_numeric:
            if numeric is None:
                raise ValueError(f"{self.name} needs the numeric column")
            scaled = (numeric - self.numeric_mean) / self.numeric_std
        each = [score.probability(weights, scaled) for score in self.scores]
        return sum(each[1:], each[0]) / len(each)


def predicted_label(probability: Column) -> Column:
    return (probability >= DECISION_THRESHOLD).cast("int")


# ------------------------------------------------------------------------ aggregation
def majority_probability(train: DataFrame) -> float:
    """1 when class 1 is the larger one; at a tie the smaller label wins."""
    row = train.agg(*[F.count_if(F.col("target") == v).alias(f"n{v}") for v in LABELS]).first()
    return float(row.n1 > row.n0)


def fit_majority(train: DataFrame, name: str = BASELINE_MODEL) -> FittedModel:
    return FittedModel(name, constant=majority_probability(train))


def class_weight_sums(train: DataFrame) -> DataFrame:
    """``i, w0, w1``: summed weights per term and class, one row per vocabulary term."""
    return (
        train.select("target", F.inline(entries_of("weights")))
        .groupBy("i")
        .agg(
            *[
                F.sum(F.when(F.col("target") == label, F.col("w")).otherwise(0.0)).alias(f"w{label}")
                for label in LABELS
            ]
        )
    )


def fit_naive_bayes(
    train: DataFrame, size: int, name: str = NAIVE_BAYES_MODEL, smoothing: float = NAIVE_BAYES_SMOOTHING
) -> FittedModel:
    """Complement naive Bayes: each class is described by the weights of the other ones.

    With two classes the complement of one is the other, so the model is one weight per
    term, the difference of the two smoothed log shares. The sums are as many as the
    vocabulary has terms, which is bounded.
    """
    sums = np.zeros((2, size))
    for row in class_weight_sums(train).collect():
        sums[:, row.i] = row.w0, row.w1
    smoothed = sums + smoothing
    log_share = np.log(smoothed / smoothed.sum(axis=1, keepdims=True))
    coefficients = (log_share[1] - log_share[0]).tolist()
    return FittedModel(name, [LinearScore(coefficients)], parameters={"alpha": smoothing})


# ------------------------------------------------------------------------- iterative
def class_sizes(train: DataFrame) -> dict[int, int]:
    row = train.agg(*[F.count_if(F.col("target") == v).alias(f"n{v}") for v in LABELS]).first()
    sizes = {v: row[f"n{v}"] for v in LABELS}
    if min(sizes.values()) == 0:
        raise ValueError("training needs rows of both classes")
    return sizes


def balanced_weights(sizes: dict[int, int]) -> Column:
    total = sum(sizes.values())
    out = F.lit(0.0)
    for label, n in sizes.items():
        out = F.when(F.col("target") == label, total / (len(sizes) * n)).otherwise(out)
    return out


def _training_frame(train: DataFrame, features: Column, sizes: dict[int, int]) -> DataFrame:
    return train.select(
        F.col("target").cast("double").alias("label"),
        features.alias("features"),
        balanced_weights(sizes).alias("balance"),
    )


def _regularisation(c: float, sizes: dict[int, int]) -> float:
    """``1 / (C * sum of weights)``; balanced weights sum to the number of rows."""
    return 1.0 / (c * sum(sizes.values()))


def fit_logistic(
    train: DataFrame,
    size: int,
    name: str = LOGISTIC_MODEL,
    c: float = LOGISTIC_C,
    numeric: str | None = None,
    max_iterations: int = MAX_ITERATIONS,
) -> FittedModel:
    """L2 logistic regression with balanced classes, optionally with one scaled number."""
    sizes = class_sizes(train)
    weights, extra, mean, std = F.col("weights"), 0, 0.0, 1.0
    if numeric:
        row = train.agg(F.avg(numeric).alias("m"), F.stddev_pop(numeric).alias("s")).first()
        mean, std = row.m, row.s or 1.0
        scaled = ((F.col(numeric) - mean) / std).cast("double")
        weights = F.concat(
            weights, F.array(F.struct(F.lit(size).alias("i"), scaled.alias("w")))
        )
        extra = 1
    frame = _training_frame(train, sparse_vector(weights, size + extra), sizes)
    model = LogisticRegression(
        weightCol="balance",
        regParam=_regularisation(c, sizes),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iterations,
        tol=TOLERANCE,
        family="binomial",
    ).fit(frame)
    values = model.coefficients.toArray().tolist()
    score = LinearScore(values[:size], model.intercept, values[size] if numeric else 0.0)
    return FittedModel(
        name,
        [score],
        uses_numeric=bool(numeric),
        numeric_mean=mean,
        numeric_std=std,
        parameters={"C": c, "class_weight": "balanced", "max_iter": max_iterations},
    )


def fit_svm(
    train: DataFrame,
    size: int,
    name: str = SVM_MODEL,
    c: float = SVM_C,
    folds: int = CALIBRATION_FOLDS,
    seed: int = SEED,
    max_iterations: int = MAX_ITERATIONS,
    tolerance: float = SVM_TOLERANCE,
) -> FittedModel:
    """Squared-hinge SVM per stratified fold, calibrated on the rows left out; probabilities are averaged."""
    rows = stratified_folds(train, folds, seed).select("weights", F.col("target").cast("int").alias("target"), "fold")
    counts = {(r.fold, r.target): r["count"] for r in rows.groupBy("fold", "target").count().collect()}
    balance = {}
    for k in range(folds):
        seen = {v: sum(n for (fold, target), n in counts.items() if target == v and fold != k) for v in LABELS}
        if min(seen.values()) == 0 or any(not counts.get((k, v)) for v in LABELS):
            raise ValueError("training needs rows of both classes in every fold")
        balance[k] = tuple(sum(seen.values()) / (len(seen) * seen[v]) for v in LABELS)
    # A pass over blocks neither decodes entries one by one nor finds the folds again.
    blocks = svm.packed(rows)
    fitted = svm.fit_leaving_out(blocks, size, range(folds), balance, c, tolerance, max_iterations)
    sigmoids = svm.fit_sigmoids(materialise(svm.margins_left_out(blocks, fitted)))
    scores = [
        LinearScore(fitted[k][:-1].tolist(), float(fitted[k][-1]), slope=sigmoids[k][0], offset=sigmoids[k][1])
        for k in range(folds)
    ]
    parameters = {
        "C": c, "class_weight": "balanced", "loss": "squared_hinge", "cv": folds, "max_iter": max_iterations, "tol": tolerance,
    }
    return FittedModel(name, scores, parameters=parameters)


def model_registry() -> dict[str, Callable[[DataFrame, int], FittedModel]]:
    """The four comparable classifiers by name; each takes training rows and vocabulary size."""
    return {
        BASELINE_MODEL: lambda train, size: fit_majority(train),
        NAIVE_BAYES_MODEL: lambda train, size: fit_naive_bayes(train, size),
        LOGISTIC_MODEL: lambda train, size: fit_logistic(train, size),
        SVM_MODEL: lambda train, size: fit_svm(train, size),
    }


def fit_models(
    train: DataFrame, size: int, names: Sequence[str] | None = None, stored_rows: bool = False
) -> dict[str, FittedModel]:
    """Fit the named models on one stored copy of the weighted training rows.

    Every iteration of a fit ships the lineage of its input, and that of the weights holds the vocabulary; reading
    a stored table keeps the tasks small. ``stored_rows`` states that ``train`` is read from one already.
    """
    registry = model_registry()
    rows = train if stored_rows else stored(train, "training")
    return {name: registry[name](rows, size) for name in names or registry}


def predictions(
    frame: DataFrame,
    models: Sequence[FittedModel],
    key: str = "id",
    numeric: str = "negativity",
    decimals: int | None = 12,
) -> DataFrame:
    """Long table ``id, model, actual, predicted, probability`` of weighted rows.

    All models score a row together, so the rows are read once. Rounding far below any
    meaningful digit makes equal texts tie exactly in ranking measures.
    """
    number = F.col(numeric) if numeric in frame.columns else None

    def probability(model: FittedModel) -> Column:
        value = model.probability(F.col("weights"), number)
        return F.round(value, decimals) if decimals is not None else value

    rows = F.array(
        *[
            bind(
                probability(model),
                lambda p: F.struct(p.alias("probability"), predicted_label(p).alias("predicted")),
            )
            for model in models
        ]
    )
    names = literal_array([model.name for model in models], "string")
    long = frame.select(key, F.col("target").alias("actual"), F.posexplode(rows).alias("_at", "_row"))
    return long.select(
        key,
        F.get(names, F.col("_at")).alias("model"),
        "actual",
        F.col("_row.predicted").alias("predicted"),
        F.col("_row.probability").alias("probability"),
    )


def weighted(model: TfidfModel, frame: DataFrame) -> DataFrame:
    """Frame with the columns models need: id, label, weights and the numeric one if there."""
    kept = [c for c in ("id", "target", "split", "negativity") if c in frame.columns]
    return model.transform(frame).select(*kept, "weights")
