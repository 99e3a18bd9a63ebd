"""Exploratory run: profile, keywords, n-grams, first models and first look at sentiment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lexigrain.fixed_values import DEMO_TEXTS_FIRST
from lexigrain.operators import charts, ngrams, reports, validation
from lexigrain.operators.features import add_features, add_sentiment
from lexigrain.operators.split import split_summary
from lexigrain.plans.experiments import evaluate_models
from lexigrain.plans.model_store import TextClassifier
from lexigrain.session import stored
from lexigrain.sources.lexicon import Lexicon
from lexigrain.sources.sinks import write_frame, write_table


def score_texts(
    spark: SparkSession, classifier: TextClassifier, texts: Sequence[str], lexicon: Lexicon | None
) -> DataFrame:
    """Score a handful of given texts end to end."""
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    return classifier.score(frame, lexicon).orderBy("id")


def run_exploratory(
    corpus: DataFrame, output: str, lexicon: Lexicon, model_names: Sequence[str] | None = None
) -> DataFrame:
    """Write every exploratory table under ``output`` and return the enriched frame.

    The enriched frame is stored once; all reports read it.
    """
    spark = corpus.sparkSession
    validation.validate_corpus(corpus)
    frame = stored(add_sentiment(add_features(corpus), lexicon), "features")
    frequencies = {
        name: ngrams.ngram_frequencies(frame, (n,), top_k=50)
        for n, name in ((1, "unigrams"), (2, "bigrams"), (3, "trigrams"))
    }
    tables = {
        "schema_profile": validation.schema_profile(frame),
        "null_rates": validation.null_rates(corpus),
        "duplicate_rows": validation.duplicate_rows(corpus),
        "label_distribution": reports.label_distribution(frame),
        "features_by_class": reports.features_by_class(frame),
        "cleaning_audit": reports.cleaning_audit(frame),
        "before_after_examples": reports.before_after_examples(frame),
        "marker_rates": reports.marker_rates(frame),
        "top_keywords": reports.top_keywords(frame),
        **frequencies,
        "discriminative_terms": ngrams.discriminative_terms(frame),
        "cloud_weights": ngrams.cloud_weights(frame),
        "length_histogram": charts.density_histogram(frame, "char_count", 35),
        "word_count_boxes": charts.box_statistics(frame, "word_count"),
        "sentiment_observed": reports.sentiment_observed(frame),
        "compound_by_class": reports.sentiment_statistics(frame, ["sentiment_compound"], names=None),
        "compound_density": charts.kernel_density(frame, "sentiment_compound", cut=0),
    }
    for name, table in tables.items():
        write_table(table, f"{output}/tables/{name}")

    experiment = evaluate_models(frame, model_names)
    write_table(experiment.metrics, f"{output}/tables/model_metrics")
    write_table(experiment.confusion, f"{output}/tables/confusion")
    write_table(experiment.roc, f"{output}/tables/roc_points")
    write_table(split_summary(experiment.split), f"{output}/tables/split_summary")
    write_frame(experiment.predictions, f"{output}/processed/predictions")
    best = experiment.best_model()
    classifier = TextClassifier(experiment.vectoriser, experiment.models[best], {"model": best})
    classifier.save(spark, f"{output}/models/first")
    write_table(score_texts(spark, classifier, DEMO_TEXTS_FIRST, lexicon), f"{output}/tables/scored_examples")
    write_frame(frame, f"{output}/processed/features")
    return frame
