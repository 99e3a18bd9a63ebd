"""Measures, curves, comparison and error analysis from long prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrain.fixed_values import (
    BASELINE_MODEL,
    BETTER,
    CORRECT,
    F1_TOLERANCE,
    FALSE_NEGATIVE,
    FALSE_POSITIVE,
    FAMILY_FIRST,
    FAMILY_SECOND,
    SAME,
    WORSE,
)
from lexigrain.operators.models import predicted_label
from lexigrain.operators.ranking import prefix_sums, value_counts

MEASURES = ("accuracy", "precision", "recall", "f1", "f1_macro", "roc_auc")
CELLS = ("tn", "fp", "fn", "tp")
COMPARED = MEASURES + CELLS
SMALLER_IS_BETTER = ("fp", "fn")

#: What a selection says of its winner.
CLEAR_WINNER = "F1 %.6f leads the next model by %.6f, more than {tolerance}"
PRACTICAL_TIE = "%d models lie within {tolerance} of the best F1; ROC-AUC %.6f is the highest of them, by %.6f"


def _ratio(part: Column, whole: Column) -> Column:
    """Quotient that is zero when nothing can be divided."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def confusion_counts(predictions: DataFrame) -> DataFrame:
    actual, predicted = F.col("actual"), F.col("predicted")
    return predictions.groupBy("model").agg(
        F.count_if((actual == 0) & (predicted == 0)).alias("tn"),
        F.count_if((actual == 0) & (predicted == 1)).alias("fp"),
        F.count_if((actual == 1) & (predicted == 0)).alias("fn"),
        F.count_if((actual == 1) & (predicted == 1)).alias("tp"),
    )


def confusion_long(predictions: DataFrame) -> DataFrame:
    """``model, actual, predicted, documents``, empty cells included."""
    long = confusion_counts(predictions).unpivot(["model"], list(CELLS), "cell", "documents")
    return long.select(
        "model",
        F.col("cell").isin("fn", "tp").cast("int").alias("actual"),
        F.col("cell").isin("fp", "tp").cast("int").alias("predicted"),
        "documents",
    )


def _score_counts(predictions: DataFrame) -> DataFrame:
    return value_counts(
        predictions.select("model", "actual", F.col("probability").alias("value")),
        ["model"],
        counts={"n1": F.count_if(F.col("actual") == 1), "n0": F.count_if(F.col("actual") == 0)},
    )


def roc_auc(predictions: DataFrame) -> DataFrame:
    """Area under the ROC curve with tied scores counting one half; null for a single class."""
    ranked = prefix_sums(_score_counts(predictions), ["model"], ["n1", "n0"])
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    pairs = F.sum("n1").cast("double") * F.sum("n0")
    area = F.sum(n1 * (F.col("before_n0") + n0 / 2))
    return ranked.groupBy("model").agg(F.when(pairs > 0, area / pairs).alias("roc_auc"))


def model_metrics(predictions: DataFrame) -> DataFrame:
    """One row per model: six measures and the four cells, from one pass over the scores."""
    ranked = prefix_sums(_score_counts(predictions), ["model"], ["n1", "n0"])
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    above = predicted_label(F.col("value")) == 1

    def cell(count: str, positive: bool) -> Column:
        return F.sum(F.when(above if positive else ~above, F.col(count)).otherwise(0))

    counted = ranked.groupBy("model").agg(
        cell("n0", False).alias("tn"),
        cell("n0", True).alias("fp"),
        cell("n1", False).alias("fn"),
        cell("n1", True).alias("tp"),
        F.sum(n1 * (F.col("before_n0") + n0 / 2)).alias("_area"),
    )
    tn, fp, fn, tp = (F.col(name) for name in CELLS)
    pairs = (tp + fn).cast("double") * (tn + fp)
    f1_of_0 = _ratio(2 * tn, 2 * tn + fp + fn)
    f1_of_1 = _ratio(2 * tp, 2 * tp + fp + fn)
    return counted.select(
        "model",
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        f1_of_1.alias("f1"),
        ((f1_of_0 + f1_of_1) / 2).alias("f1_macro"),
        F.when(pairs > 0, F.col("_area") / pairs).alias("roc_auc"),
        *CELLS,
    )


def ranked_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("f1"), F.desc("roc_auc"), F.desc("recall"), "model")


def roc_points(predictions: DataFrame, drop_collinear: bool = True) -> DataFrame:
    """``model, fpr, tpr, threshold`` from the origin (infinite threshold) to (1, 1).

    A point between two equal steps lies on a straight line and can be left out.
    """
    ranked = prefix_sums(_score_counts(predictions), ["model"], ["n1", "n0"], neighbours=True)
    ranked = ranked.where((F.col("total_n1") > 0) & (F.col("total_n0") > 0))
    highest = (F.col("before_n1") + F.col("n1") == F.col("total_n1")) & (
        F.col("before_n0") + F.col("n0") == F.col("total_n0")
    )
    lowest = F.col("lower_n1").isNull()
    bends = (F.col("lower_n1") != F.col("n1")) | (F.col("lower_n0") != F.col("n0"))
    kept = ranked.where(highest | lowest | bends) if drop_collinear else ranked
    points = kept.select(
        "model",
        ((F.col("total_n0") - F.col("before_n0")) / F.col("total_n0")).alias("fpr"),
        ((F.col("total_n1") - F.col("before_n1")) / F.col("total_n1")).alias("tpr"),
        F.col("value").alias("threshold"),
        highest.alias("_first"),
    )
    # The point of the highest score also yields the origin.
    origin = F.struct(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    own = F.struct("fpr", "tpr", "threshold")
    return points.select(
        "model", F.inline(F.when(F.col("_first"), F.array(origin, own)).otherwise(F.array(own)))
    )


def metric_differences(metrics: DataFrame, without: str, with_numeric: str) -> DataFrame:
    """Both experiments side by side, their difference and whether it is an improvement."""
    doubles = [F.col(name).cast("double").alias(name) for name in COMPARED]
    long = metrics.select("model", *doubles).unpivot(["model"], list(COMPARED), "metric", "value")

    def of(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col("value")))

    pairs = long.groupBy("metric").agg(of(without).alias("model_a"), of(with_numeric).alias("model_b"))
    difference = F.col("model_b") - F.col("model_a")
    gain = F.when(F.col("metric").isin(*SMALLER_IS_BETTER), -difference).otherwise(difference)
    direction = F.when(gain > 0, F.lit(BETTER)).when(gain < 0, F.lit(WORSE)).otherwise(F.lit(SAME))
    return pairs.select(
        "metric", "model_a", "model_b", difference.alias("difference"), direction.alias("direction")
    )


def model_catalogue(first: DataFrame, second: DataFrame, numeric_models: Sequence[str]) -> DataFrame:
    """Both metric tables in one, with the family and whether the number is used."""
    tagged = first.withColumn("family", F.lit(FAMILY_FIRST)).unionByName(
        second.withColumn("family", F.lit(FAMILY_SECOND)), allowMissingColumns=True
    )
    uses = F.col("model").isin(list(numeric_models)) if numeric_models else F.lit(False)
    return tagged.withColumn("uses_negativity", uses).orderBy(F.desc("f1"), F.desc("roc_auc"), "model")


def best_first_family(catalogue: DataFrame) -> DataFrame:
    """Best classifier of the first family; the majority baseline does not compete."""
    rivals = catalogue.where((F.col("family") == FAMILY_FIRST) & (F.col("model") != BASELINE_MODEL))
    return rivals.orderBy(F.desc("f1"), "model").limit(1)


def select_model(metrics: DataFrame, tolerance: float = F1_TOLERANCE) -> DataFrame:
    """``model, reason``: F1 decides, ROC-AUC only among models within the tolerance.

    A catalogue has one row per model, so its few rows are gathered in one array.
    """
    table = metrics.select("model", F.col("f1").cast("double"), F.col("roc_auc").cast("double"))
    rows = table.agg(F.collect_list(F.struct("model", "f1", "roc_auc")).alias("rows")).withColumn(
        "best", F.array_max(F.transform("rows", lambda r: r["f1"]))
    )
    split = rows.select(
        "best",
        F.array_sort(
            F.transform(
                F.filter("rows", lambda r: r["f1"] >= F.col("best") - tolerance),
                lambda r: F.struct(
                    (-r["roc_auc"]).alias("a"), (-r["f1"]).alias("b"), r["model"].alias("model")
                ),
            )
        ).alias("rivals"),
        F.array_max(
            F.transform(
                F.filter("rows", lambda r: r["f1"] < F.col("best") - tolerance), lambda r: r["f1"]
            )
        ).alias("runner_up"),
    )
    rivals = F.col("rivals")
    winner_auc, second_auc = -F.get(rivals, F.lit(0))["a"], -F.get(rivals, F.lit(1))["a"]
    reason = F.when(
        F.size(rivals) == 1,
        F.format_string(
            CLEAR_WINNER.format(tolerance=tolerance), F.col("best"), F.col("best") - F.col("runner_up")
        ),
    ).otherwise(
        F.format_string(
            PRACTICAL_TIE.format(tolerance=tolerance), F.size(rivals), winner_auc, winner_auc - second_auc
        )
    )
    return split.select(F.get(rivals, F.lit(0))["model"].alias("model"), reason.alias("reason"))


def require_rivals(metrics: DataFrame) -> DataFrame:
    if len(metrics.limit(2).collect()) < 2:
        raise ValueError("a selection needs at least two models")
    return metrics


def with_context(predictions: DataFrame, documents: DataFrame, key: str = "id") -> DataFrame:
    """Predictions joined to the columns of their documents."""
    return predictions.join(documents.drop("target"), key, "left")


def with_outcome(predictions: DataFrame) -> DataFrame:
    """Add the kind of error and the confidence of each prediction."""
    wrong_up = (F.col("actual") == 0) & (F.col("predicted") == 1)
    wrong_down = (F.col("actual") == 1) & (F.col("predicted") == 0)
    outcome = (
        F.when(wrong_up, F.lit(FALSE_POSITIVE)).when(wrong_down, F.lit(FALSE_NEGATIVE)).otherwise(F.lit(CORRECT))
    )
    return predictions.withColumns(
        {"error_type": outcome, "confidence": F.abs(F.col("probability") - 0.5)}
    )


ERROR_COLUMNS = (
    "id",
    "error_type",
    "text",
    "clean_text",
    "actual",
    "predicted",
    "probability",
    "sentiment_label",
    "sentiment_compound",
    "negativity",
    "keyword",
)


def error_table(outcomes: DataFrame, per_type: int | None = None) -> DataFrame:
    """Wrong predictions, surest first; with ``per_type`` only that many of each kind."""
    errors = outcomes.where(F.col("error_type") != CORRECT)
    if per_type is not None:
        order = Window.partitionBy("error_type").orderBy(F.desc("confidence"), "id")
        errors = errors.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_type)
    return errors.orderBy("error_type", F.desc("confidence"), "id").select(*ERROR_COLUMNS)


def hit_profile(outcomes: DataFrame) -> DataFrame:
    """Cases, hits and means per sentiment."""
    hit = (F.col("actual") == F.col("predicted")).cast("long")
    return outcomes.groupBy("sentiment_label").agg(
        F.count(F.lit(1)).alias("cases"),
        F.sum(hit).alias("hits"),
        F.avg("negativity").alias("mean_negativity"),
        F.avg("probability").alias("mean_probability"),
        (F.sum(hit) / F.count(F.lit(1))).alias("hit_rate"),
    )


def errors_by_sentiment(outcomes: DataFrame) -> DataFrame:
    return (
        outcomes.where(F.col("error_type") != CORRECT)
        .groupBy("error_type", "sentiment_label")
        .agg(F.count(F.lit(1)).alias("cases"))
    )
