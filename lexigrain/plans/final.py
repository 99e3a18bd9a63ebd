"""Final run: sentiment, contrast, both model experiments, selection, errors and summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrain.fixed_values import (
    BOOTSTRAP_RESAMPLES,
    CORRECT,
    DEMO_TEXTS_FINAL,
    LOGISTIC_MODEL,
    MAX_DOCUMENT_SHARE,
    MAX_TERMS,
    MIN_DOCUMENTS,
    MODEL_A,
    MODEL_B,
    SEED,
)
from lexigrain.operators import charts, contrast, evaluation, ngrams, reports, validation
from lexigrain.operators.features import add_features, add_sentiment
from lexigrain.operators.split import same_split, split_summary
from lexigrain.plans.experiments import compare_negativity, differences, evaluate_models
from lexigrain.plans.exploratory import score_texts
from lexigrain.plans.model_store import TextClassifier
from lexigrain.session import materialise, stored
from lexigrain.sources.lexicon import Lexicon
from lexigrain.sources.sinks import write_frame, write_json_row, write_table

CONTRAST_METRICS = ("negativity", "sentiment_negative", "sentiment_compound")


def _as_map(table: DataFrame, key: str, value: str) -> DataFrame:
    """A small report (one row per label, indicator or metric) as one map column."""
    return table.agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m"))


def run_final(
    corpus: DataFrame,
    output: str,
    lexicon: Lexicon,
    resamples: int = BOOTSTRAP_RESAMPLES,
    model_names: Sequence[str] | None = None,
) -> TextClassifier:
    """Write every final table, the chosen model and the run summary under ``output``."""
    spark = corpus.sparkSession
    validation.validate_corpus(corpus)
    frame = stored(add_sentiment(add_features(corpus), lexicon), "sentiment")
    audit = materialise(contrast.negativity_audit(frame))
    compared = materialise(
        contrast.compare_groups(frame, CONTRAST_METRICS, resamples=resamples, small_domain=True)
    )
    tables = {
        "stopword_audit": ngrams.stop_word_audit(frame),
        "sentiment_by_class": reports.sentiment_by_class(frame),
        "sentiment_global": reports.sentiment_global(frame),
        "sentiment_statistics": reports.sentiment_statistics(frame),
        "sentiment_thresholds": reports.threshold_catalogue(spark),
        "sentiment_words": reports.mean_sentiment_words(frame),
        "extremes": reports.tagged_extremes(frame),
        "extremes_composition": reports.extremes_composition(frame),
        "extremes_patterns": reports.extremes_patterns(frame),
        "group_contrast": compared,
        "negativity_audit": audit,
        "negativity_ranges": reports.negativity_ranges(frame),
        "negativity_ecdf": charts.ecdf(frame, "negativity", small_domain=True),
        "negativity_boxes": charts.box_statistics(frame, "negativity", small_domain=True),
        "negativity_histogram": charts.density_histogram(frame.where("negativity > 0"), "negativity", 30),
        "compound_density": charts.kernel_density(frame, "sentiment_compound"),
    }
    for name, table in tables.items():
        write_table(table, f"{output}/tables/{name}")

    first = evaluate_models(frame, model_names)
    second = compare_negativity(frame, first.models.get(LOGISTIC_MODEL), first)
    if not same_split(first.split, second.split):
        raise RuntimeError("the experiments used different validation rows")
    scored = second.predictions
    first_metrics, second_metrics = materialise(first.metrics), materialise(second.metrics)
    changes = materialise(differences(second))
    catalogue = materialise(evaluation.model_catalogue(first_metrics, second_metrics, [MODEL_B]))
    write_table(first_metrics, f"{output}/tables/model_metrics")
    write_table(first.confusion, f"{output}/tables/confusion")
    write_table(first.roc, f"{output}/tables/roc_points")
    write_table(second_metrics, f"{output}/tables/negativity_metrics")
    write_table(changes, f"{output}/tables/negativity_differences")
    write_table(catalogue, f"{output}/tables/model_catalogue")
    write_table(split_summary(second.split), f"{output}/tables/split_summary")

    choice = evaluation.select_model(evaluation.require_rivals(second_metrics)).first()
    family = evaluation.best_first_family(catalogue).first()
    winner = second.models[choice.model]
    # One row per part of the split.
    parts_of_split = {row["split"]: row for row in split_summary(second.split).collect()}
    metadata = {
        "model": choice.model,
        "uses_negativity": winner.uses_numeric,
        "reason": choice.reason,
        "candidates": [MODEL_A, MODEL_B],
        "base_family": family.model if family else None,
        "parameters": winner.parameters,
        "seed": SEED,
        "vocabulary": {
            "ngram_sizes": list(second.vectoriser.sizes),
            "min_documents": MIN_DOCUMENTS,
            "max_document_share": MAX_DOCUMENT_SHARE,
            "max_terms": MAX_TERMS,
            "terms": second.vectoriser.size,
        },
        "documents": {part: row.documents for part, row in parts_of_split.items()},
        "positive_pct": {part: row.positive_pct for part, row in parts_of_split.items()},
        "validation": second_metrics.where(F.col("model") == choice.model).first().asDict(),
    }
    classifier = TextClassifier(second.vectoriser, winner, metadata)
    classifier.save(spark, f"{output}/models/final")
    write_table(score_texts(spark, classifier, DEMO_TEXTS_FINAL, lexicon), f"{output}/tables/scored_examples")

    chosen = scored.where(F.col("model") == choice.model)
    outcomes = materialise(evaluation.with_outcome(evaluation.with_context(chosen, frame)))
    write_table(evaluation.error_table(outcomes), f"{output}/tables/errors")
    write_table(evaluation.error_table(outcomes, per_type=15), f"{output}/tables/errors_top")
    write_table(evaluation.hit_profile(outcomes), f"{output}/tables/hit_profile")
    write_table(evaluation.errors_by_sentiment(outcomes), f"{output}/tables/errors_by_sentiment")
    outcome_chart = outcomes.withColumn("hit", (F.col("error_type") == CORRECT).cast("int"))
    write_table(
        charts.density_histogram(outcome_chart, "probability", 30, group="hit"),
        f"{output}/tables/probability_histogram",
    )

    errors = outcomes.where(F.col("error_type") != CORRECT).groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))
    parts = {
        "sentiment": _as_map(reports.sentiment_global(frame), "sentiment_label", "documents"),
        "negativity": _as_map(audit, "indicator", "value"),
        "contrast": compared.where("metric = 'negativity'").select(F.struct("*").alias("m")),
        "final_model": second_metrics.where(F.col("model") == choice.model).select(F.struct("*").alias("m")),
        "negativity_effect": changes.agg(
            F.map_from_entries(
                F.collect_list(
                    F.struct("metric", F.struct("model_a", "model_b", "difference", "direction").alias("effect"))
                )
            ).alias("m")
        ),
        "errors": _as_map(errors, "error_type", "n"),
    }
    summary = spark.range(1).select(
        F.lit(frame.count()).alias("documents"),
        F.lit(SEED).alias("seed"),
        F.lit(winner.uses_numeric).alias("uses_negativity"),
        F.lit(choice.reason).alias("reason"),
        *[part.scalar().alias(name) for name, part in parts.items()],
    )
    write_json_row(summary.select(F.to_json(F.struct("*")).alias("value")), f"{output}/summary")
    write_frame(frame, f"{output}/processed/sentiment")
    write_frame(scored, f"{output}/processed/predictions")
    return classifier
