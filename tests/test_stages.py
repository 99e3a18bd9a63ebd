"""The models as Spark ML stages, the reweighted solver, and idempotent stream batches."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from lexigrain.fixed_values import LOGISTIC_C
from lexigrain.operators.models import fit_logistic, weighted
from lexigrain.operators.reweighted import INTERCEPT, fit_reweighted
from lexigrain.operators.tfidf import TfidfModel
from lexigrain.plans import stages
from lexigrain.plans.model_store import TextClassifier
from lexigrain.sources.lexicon import Lexicon
from lexigrain.streaming.scoring import read_batches, read_text_stream, score_in_batches, write_batch

WORDS = ["fire", "flood", "smoke", "music", "party", "lunch", "street", "today"]


@pytest.fixture(scope="module")
def texts(spark):
    draw = np.random.default_rng(1)
    rows = []
    for at in range(160):
        target = int(at % 2)
        weights = np.array([4, 4, 4, 1, 1, 1, 2, 2] if target else [1, 1, 1, 4, 4, 4, 2, 2], dtype=float)
        rows.append((at, " ".join(draw.choice(WORDS, 6, p=weights / weights.sum())), float(draw.random()), target))
    return spark.createDataFrame(rows, "id long, clean_text string, negativity double, target int").cache()


def scored(model, frame):
    return [tuple(r) for r in model.transform(frame).orderBy("id").select("id", "probability", "prediction", "rawPrediction").collect()]


@pytest.mark.parametrize("name", list(stages.pipeline_registry()))
def test_fitted_pipelines_survive_storage(spark, texts, tmp_path, name):
    model = stages.pipeline_registry()[name].fit(texts)
    rows = scored(model, texts)
    model.write().overwrite().save(str(tmp_path / "fitted"))
    loaded = PipelineModel.load(str(tmp_path / "fitted"))
    assert scored(loaded, texts) == rows
    assert loaded.stages[0].vectoriser.terms == model.stages[0].vectoriser.terms and loaded.stages[1].uid == model.stages[1].uid
    assert all(p in (0.0, 1.0) for _, _, p, _ in rows)


def test_number_is_a_parameter(spark, texts, tmp_path):
    pipelines = stages.negativity_pipelines()
    pipeline = list(pipelines.values())[1]
    pipeline.write().overwrite().save(str(tmp_path / "unfitted"))
    assert Pipeline.load(str(tmp_path / "unfitted")).getStages()[1].getOrDefault("numericCol") == "negativity"
    model = pipeline.fit(texts)
    assert model.stages[1].fitted.uses_numeric and len(pipelines) == 2
    model.save(str(tmp_path / "b"))
    assert scored(PipelineModel.load(str(tmp_path / "b")), texts) == scored(model, texts)


def test_tuning_by_cross_validation(texts):
    pipeline = stages.text_pipeline(stages.NAIVE_BAYES)
    weighting, model = pipeline.getStages()
    grid = ParamGridBuilder().addGrid(model.smoothing, [0.5, 50.0]).addGrid(weighting.sizes, [[1], [1, 2]]).build()
    evaluator = BinaryClassificationEvaluator(labelCol="target")
    found = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=2, seed=3).fit(texts)
    assert len(found.avgMetrics) == 4 and max(found.avgMetrics) > 0.8
    assert evaluator.evaluate(found.bestModel.transform(texts)) > 0.9


def test_vectors_feed_other_classifiers(texts):
    fitted = stages.TermWeighting(minDocuments=3).fit(texts)
    row = fitted.transform(texts).first()
    assert row.features.size == fitted.vectoriser.size
    assert dict(zip(row.features.indices.tolist(), row.features.values.tolist())) == {e.i: e.w for e in row.weights}
    other = NaiveBayes(labelCol="target", featuresCol="features").fit(fitted.transform(texts))
    assert other.numFeatures == fitted.vectoriser.size


def test_unknown_algorithm(texts):
    with pytest.raises(ValueError, match="unknown algorithm"):
        stages.text_pipeline("forest").fit(texts)


def plain_logistic(x, y, share, c):
    """Newton steps on the penalised log loss; the intercept, first, is free."""
    penalty = np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    b = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ b))
        gradient = penalty @ b + c * x.T @ (share * (p - y))
        b = b - np.linalg.solve(penalty + c * (x.T * (share * p * (1 - p))) @ x, gradient)
    return b


def test_logistic_fits_agree(spark, texts):
    """The classifier over sparse weights, the reweighted solver and plain numpy on one small vocabulary."""
    vectoriser = TfidfModel.fit(texts, sizes=(1,))
    rows = weighted(vectoriser, texts)
    model = fit_logistic(rows, vectoriser.size)
    names = [f"x{i}" for i in range(vectoriser.size)]

    def weight_of(i):
        here = F.filter("weights", lambda entry: entry["i"] == i)
        return F.coalesce(F.get(F.transform(here, lambda entry: entry["w"]), F.lit(0)), F.lit(0.0))

    wide = rows.select("target", *[weight_of(i).alias(name) for i, name in enumerate(names)]).cache()
    found = fit_reweighted(wide, names, steps=25, tolerance=1e-10)
    data = np.array([list(map(float, r)) for r in wide.collect()])
    x, y = np.column_stack([np.ones(len(data)), data[:, 1:]]), data[:, 0]
    plain = plain_logistic(x, y, np.ones(len(y)), LOGISTIC_C)  # both classes are equally large
    assert [found[INTERCEPT], *[found[n] for n in names]] == pytest.approx(plain.tolist(), abs=1e-6)
    assert [model.scores[0].intercept, *model.scores[0].coefficients] == pytest.approx(plain.tolist(), abs=2e-3)


def test_text_only_scoring(spark, texts):
    model = stages.text_pipeline(stages.NAIVE_BAYES).fit(texts)
    classifier = TextClassifier(model.stages[0].vectoriser, model.stages[1].fitted)
    raw = spark.createDataFrame([(1, "Fire, fire & smoke!", "x"), (2, None, "y")], "id long, text string, other string")
    plain = classifier.score(raw)
    assert plain.columns == ["id", "text", "other", "clean_text", "predicted_class", "probability"]
    both = classifier.score(raw, Lexicon()).select(plain.columns)
    assert plain.orderBy("id").collect() == both.orderBy("id").collect()


def test_replayed_batches_write_once(spark, texts, tmp_path):
    model = stages.text_pipeline(stages.NAIVE_BAYES).fit(texts)
    classifier = TextClassifier(model.stages[0].vectoriser, model.stages[1].fitted)
    raw = spark.createDataFrame([(i, f"fire and smoke {i}" if i % 2 else None) for i in range(40)], "id long, text string")
    folder, out = tmp_path / "in", str(tmp_path / "out")
    raw.repartition(4).write.parquet(str(folder))
    known = spark.createDataFrame([(3,), (4,)], "id long")

    def unknown(batch):
        return batch.join(known, "id", "left_anti")

    wanted = sorted(map(tuple, classifier.score(unknown(raw), Lexicon()).collect()))
    shape = classifier.score(raw, Lexicon()).schema
    for run in range(2):  # the second run has lost its record of what was done
        stream = read_text_stream(spark, str(folder), raw.schema, files_per_trigger=1)
        score_in_batches(stream, classifier, out, str(tmp_path / f"state{run}"), Lexicon(), unknown).awaitTermination()
        assert sorted(map(tuple, read_batches(spark, out, shape).collect())) == wanted
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("batch=")]) == 4
    write_batch(classifier.score(raw.limit(0), Lexicon()), out, 0)
    assert read_batches(spark, out, shape).count() < len(wanted)
