"""Both complete runs on a small labelled corpus."""

import json

from pyspark.sql import functions as F

from lexigrain.fixed_values import BASELINE_MODEL, LOGISTIC_MODEL, NAIVE_BAYES_MODEL, SVM_MODEL
from lexigrain.plans.exploratory import run_exploratory
from lexigrain.plans.final import run_final
from lexigrain.sources.lexicon import Lexicon
from tests.test_models import DISASTER, ORDINARY

NAMES = [BASELINE_MODEL, NAIVE_BAYES_MODEL, LOGISTIC_MODEL]


def corpus(spark):
    texts = [(f"{t} terrible!", 1) for t in DISASTER * 8] + [(f"{t} #great", 0) for t in ORDINARY * 8]
    rows = [(i, "k%20w" if i % 2 else None, None, t, y) for i, (t, y) in enumerate(texts)]
    return spark.createDataFrame(rows, "id long, keyword string, location string, text string, target int")


def test_exploratory_run(spark, tmp_path):
    frame = run_exploratory(corpus(spark), str(tmp_path), Lexicon(), [*NAMES, SVM_MODEL])
    assert frame.count() == 80
    metrics = spark.read.option("header", True).csv(str(tmp_path / "tables/model_metrics"))
    assert metrics.count() == 4
    fitted = metrics.where(F.col("model").isin(LOGISTIC_MODEL, SVM_MODEL)).collect()
    assert [float(row.f1) for row in fitted] == [1.0, 1.0]
    examples = spark.read.option("header", True).csv(str(tmp_path / "tables/scored_examples"))
    assert [r.compound for r in examples.orderBy("id").collect()] == ["-0.4003", "0.1494", "-0.3818"]


def test_final_run(spark, tmp_path):
    classifier = run_final(corpus(spark), str(tmp_path), Lexicon(), resamples=100, model_names=NAMES)
    summary = json.loads(spark.read.text(str(tmp_path / "summary")).first().value)
    assert summary["documents"] == 80 and sum(summary["sentiment"].values()) == 80
    assert summary["final_model"]["model"] == classifier.metadata["model"]
    effect = summary["negativity_effect"]["f1"]
    assert effect["difference"] == effect["model_b"] - effect["model_a"] and effect["direction"]
    assert summary["seed"] == 42 and summary["uses_negativity"] == classifier.model.uses_numeric
    assert classifier.metadata["documents"] == {"train": 64, "test": 16}
    assert classifier.metadata["vocabulary"]["terms"] == classifier.vectoriser.size
    predictions = spark.read.option("header", True).csv(str(tmp_path / "processed/predictions"))
    assert predictions.where(F.col("model") == classifier.model.name).count() == 16
