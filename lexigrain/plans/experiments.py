"""The two model experiments: four classifiers, and one classifier with and without a number."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrain.fixed_values import MODEL_A, MODEL_B
from lexigrain.operators.evaluation import (
    confusion_long,
    metric_differences,
    model_metrics,
    ranked_metrics,
    roc_points,
)
from lexigrain.operators.models import FittedModel, fit_logistic, fit_models, predictions, weighted
from lexigrain.operators.split import TEST, TRAIN, stratified_split
from lexigrain.operators.tfidf import TfidfModel
from lexigrain.session import materialise, stored

EXPERIMENT_COLUMNS = ("clean_text", "negativity", "target")


@dataclass(frozen=True)
class Experiment:
    """Fitted models and result tables over one split; the predictions are stored."""

    vectoriser: TfidfModel
    models: dict[str, FittedModel]
    split: DataFrame
    predictions: DataFrame
    rows: DataFrame

    @property
    def metrics(self) -> DataFrame:
        sizes = self.split.agg(
            F.count_if(F.col("split") == TRAIN).alias("train"),
            F.count_if(F.col("split") == TEST).alias("test"),
        ).first()
        table = model_metrics(self.predictions)
        counts = {"n_train": F.lit(sizes.train), "n_test": F.lit(sizes.test)}
        return ranked_metrics(table.withColumns(counts))

    @property
    def confusion(self) -> DataFrame:
        return confusion_long(self.predictions)

    @property
    def roc(self) -> DataFrame:
        return roc_points(self.predictions)

    def best_model(self) -> str:
        return self.metrics.first().model


def _prepared(frame: DataFrame) -> tuple[DataFrame, TfidfModel, DataFrame]:
    # Vocabulary and weights read the cleaned text, training and validation the weights; each is stored once.
    kept = [name for name in ("id", *EXPERIMENT_COLUMNS) if name in frame.columns]
    split = stratified_split(stored(frame.select(*kept), "experiment"))
    vectoriser = TfidfModel.fit(split.where(F.col("split") == TRAIN))
    return split, vectoriser, stored(weighted(vectoriser, split), "weights")


def evaluate_models(frame: DataFrame, names: Sequence[str] | None = None) -> Experiment:
    """Fit the registry on one stratified split and predict its validation rows."""
    split, vectoriser, rows = _prepared(frame)
    models = fit_models(rows.where(F.col("split") == TRAIN), vectoriser.size, names, stored_rows=True)
    scored = predictions(rows.where(F.col("split") == TEST), list(models.values()))
    return Experiment(vectoriser, models, split, materialise(scored), rows)


def compare_negativity(
    frame: DataFrame, fitted_a: FittedModel | None = None, first: Experiment | None = None
) -> Experiment:
    """The same logistic regression without (A) and with (B) the negativity score.

    A is the plain text model; a fit made on the same split can be handed in, and an experiment
    over the same frame, whose split, vocabulary and weights are then used.
    """
    lacking = [name for name in EXPERIMENT_COLUMNS if name not in frame.columns]
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    split, vectoriser, rows = (first.split, first.vectoriser, first.rows) if first else _prepared(frame)
    train = rows.where(F.col("split") == TRAIN)
    plain = fitted_a or fit_logistic(train, vectoriser.size, MODEL_A)
    models = {
        MODEL_A: replace(plain, name=MODEL_A),
        MODEL_B: fit_logistic(train, vectoriser.size, MODEL_B, numeric="negativity"),
    }
    scored = predictions(rows.where(F.col("split") == TEST), list(models.values()))
    return Experiment(vectoriser, models, split, materialise(scored), rows)


def differences(experiment: Experiment) -> DataFrame:
    return metric_differences(model_metrics(experiment.predictions), MODEL_A, MODEL_B)
