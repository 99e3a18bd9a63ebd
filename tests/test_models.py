"""Split, weights, classifiers, evaluation, storage and streaming on a toy corpus."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrain.fixed_values import BASELINE_MODEL, LOGISTIC_MODEL, MODEL_A, MODEL_B, NAIVE_BAYES_MODEL
from lexigrain.operators import evaluation
from lexigrain.operators.models import fit_models, model_registry, weighted
from lexigrain.operators.split import TEST, TRAIN, same_split, split_summary, stratified_split, test_quotas as quotas_of
from lexigrain.operators.tfidf import TfidfModel
from lexigrain.plans.experiments import compare_negativity, differences, evaluate_models
from lexigrain.plans.model_store import TextClassifier
from lexigrain.sources.lexicon import Lexicon
from lexigrain.streaming.scoring import read_text_stream, score_stream

DISASTER = [
    "wildfire evacuation emergency crews",
    "earthquake collapse buildings rescue",
    "flood damage homes destroyed",
    "hurricane landfall storm surge",
    "explosion downtown casualties reported",
]
ORDINARY = [
    "movie tonight popcorn friends",
    "coffee morning routine music",
    "football match great goal",
    "birthday party cake balloons",
    "shopping mall new shoes",
]


@pytest.fixture(scope="module")
def toy(spark):
    generator = np.random.default_rng(0)
    texts = [(t, 1) for t in DISASTER * 12] + [(t, 0) for t in ORDINARY * 12]
    rows = [(i, t, float(generator.uniform()), y) for i, (t, y) in enumerate(texts)]
    return spark.createDataFrame(rows, "id long, clean_text string, negativity double, target int")


def test_quotas_of_the_published_split():
    assert quotas_of({0: 4342, 1: 3271}) == {0: 869, 1: 654}


def test_split_is_exact_and_repeatable(spark):
    frame = spark.range(7613).select("id", (F.col("id") < 3271).cast("int").alias("target"))
    split = stratified_split(frame)
    rows = {r.split: (r.documents, r.positives) for r in split_summary(split).collect()}
    assert rows == {TRAIN: (6090, 2617), TEST: (1523, 654)}
    assert same_split(split, stratified_split(frame))


def test_registry_names():
    assert len(model_registry()) == 4


def test_weights_match_the_definition(spark):
    texts = [(0, "aa bb aa"), (1, "bb cc"), (2, "aa bb")]
    frame = spark.createDataFrame(texts, "id long, clean_text string")
    model = TfidfModel.fit(frame, max_df=1.0)
    assert model.terms == ("aa", "aa bb", "bb")
    row = model.transform(frame).where("id = 0").first()
    idf = dict(zip(model.terms, model.idf))
    raw = np.array([(1 + np.log(2)) * idf["aa"], idf["aa bb"], idf["bb"]])
    assert [e.w for e in row.weights] == pytest.approx((raw / np.linalg.norm(raw)).tolist())


def test_models_learn_and_survive_storage(spark, toy, tmp_path):
    experiment = evaluate_models(toy, [BASELINE_MODEL, NAIVE_BAYES_MODEL, LOGISTIC_MODEL])
    metrics = {r.model: r for r in experiment.metrics.collect()}
    assert metrics[LOGISTIC_MODEL].f1 == 1.0 and metrics[NAIVE_BAYES_MODEL].roc_auc == 1.0
    assert metrics[BASELINE_MODEL].roc_auc == 0.5 and metrics[BASELINE_MODEL].n_test == 24
    # Both separate the toy classes; the tie goes to the smaller name.
    assert experiment.best_model() == NAIVE_BAYES_MODEL

    texts = spark.createDataFrame(
        [(1, "BREAKING: wildfire evacuation @city https://t.co/x #fire"), (2, ""), (3, None)], "id long, text string"
    )
    classifier = TextClassifier(experiment.vectoriser, experiment.models[LOGISTIC_MODEL], {"note": "toy"})
    scored = classifier.score(texts, Lexicon()).orderBy("id").collect()
    assert scored[0].predicted_class == "Desastre real" and scored[0].clean_text == "breaking wildfire evacuation"
    assert [(r.clean_text, r.sentiment, r.negativity, r.text) for r in scored[1:]] == [("", "neutral", 0.0, "")] * 2

    classifier.save(spark, str(tmp_path / "model"))
    loaded = TextClassifier.load(spark, str(tmp_path / "model"))
    assert loaded.metadata == {"note": "toy"}
    assert loaded.score(texts, Lexicon()).orderBy("id").collect() == scored

    texts.write.parquet(str(tmp_path / "in"))
    stream = read_text_stream(spark, str(tmp_path / "in"), texts.schema)
    score_stream(stream, loaded, str(tmp_path / "out"), str(tmp_path / "state"), Lexicon()).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect() == scored


def test_negativity_experiment(toy):
    experiment = compare_negativity(toy)
    table = differences(experiment).collect()
    assert set(experiment.models) == {MODEL_A, MODEL_B} and len(table) == 10
    assert {r.direction for r in table} <= {"mejora", "empeora", "sin cambio"}
    with pytest.raises(ValueError, match="missing columns"):
        compare_negativity(toy.drop("negativity"))


def metrics_frame(spark, rows):
    return spark.createDataFrame(rows, "model string, f1 double, roc_auc double")


def test_selection_rule(spark):
    clear = evaluation.select_model(metrics_frame(spark, [(MODEL_A, 0.780938, 0.866635), (MODEL_B, 0.763804, 0.867043)])).first()
    assert clear.model == MODEL_A and "leads the next model by 0.017134" in clear.reason
    tie = evaluation.select_model(metrics_frame(spark, [(MODEL_A, 0.7810, 0.8600), (MODEL_B, 0.7801, 0.8700)])).first()
    assert tie.model == MODEL_B and "ROC-AUC" in tie.reason
    with pytest.raises(ValueError):
        evaluation.require_rivals(metrics_frame(spark, [(MODEL_A, 0.8, 0.9)]))


def test_zero_division_and_single_class(spark):
    rows = [("m", i, 0, 0, 0.1) for i in range(4)]
    frame = spark.createDataFrame(rows, "model string, id long, actual int, predicted int, probability double")
    row = evaluation.model_metrics(frame).first()
    assert (row.precision, row.recall, row.f1, row.roc_auc, row.tn) == (0.0, 0.0, 0.0, None, 4)


def test_fit_models_reports_missing_class(toy):
    model = TfidfModel.fit(toy)
    with pytest.raises(ValueError):
        fit_models(weighted(model, toy.where("target = 1")), model.size, [LOGISTIC_MODEL])
