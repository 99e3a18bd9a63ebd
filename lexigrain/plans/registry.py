"""Every operator as a query over the driver tables.

Texts of the tables hold few of the marks the cleaning rules look for, so most queries
append a phrase that depends on the language of the document. Work grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrain.fixed_values import BASELINE_MODEL, F1_TOLERANCE, MODEL_B, NAIVE_BAYES_MODEL, SENTIMENT_NEGATORS
from lexigrain.functions.cleaning import clean_for_sentiment, expand_contractions
from lexigrain.functions.entities import unescape_html
from lexigrain.functions.expressions import reuse
from lexigrain.functions.markers import (
    contains_negation,
    decode_percent,
    length_features,
    most_repeated_token,
    surface_markers,
    uppercase_percent,
)
from lexigrain.functions.polarity import polarity_scores, sentiment_word_counts
from lexigrain.operators import charts, contrast, evaluation, ngrams, reports, validation
from lexigrain.operators.features import add_clean_text, add_features, add_sentiment
from lexigrain.operators.models import (
    FittedModel,
    fit_models,
    majority_probability,
    predicted_label,
    predictions,
    sigmoid,
    weighted,
)
from lexigrain.operators.reweighted import INTERCEPT, fit_reweighted
from lexigrain.operators.split import TEST, TRAIN, split_summary, stratified_split
from lexigrain.operators.tfidf import TfidfModel, long_weights
from lexigrain.plans.experiments import compare_negativity, differences, evaluate_models
from lexigrain.plans.model_store import TextClassifier
from lexigrain.sources.corpus import corpus_from_tables, spread, unlabelled_documents
from lexigrain.session import materialise, shared_path, stored
from lexigrain.sources.lexicon import Lexicon, boosters, starter_valences
from lexigrain.streaming.scoring import read_batches, read_text_stream, score_in_batches

Query = Callable[[SparkSession, str], DataFrame]

# Phrases appended by language (fixed values).
MARK_PHRASES = {
    "en": " I can't wait, they’re GONE! Call 911 now @user_1 and @é2 #Flood911 https://t.co/a1?b=2 www.x.org &amp;lt; 12 days",
    "de": " won't #Sturm isn't 100% sure?? HTTPS://X.test we've said he'd go & I'm @ home no",
    "fr": " 911! you'll see: cross-body didn’t ² nine nineoneone NEVER",
}
SENTIMENT_PHRASES = {
    "en": " It was NOT very good, but the GREAT party was so fun 😂😂ok the end!!",
    "de": " never so good at least bad, no awful or nice thing kind of happy without doubt lovely?? kind kiss of death",
    "fr": " sort of terrible day that was no great fun, least ugly; yeah right :) ???? EXTREMELY HORRIBLE 😢",
}
# References appended to every page: numeric, bare, unknown and out of range (fixed value).
REFERENCES = " &#128514;&#x1F602; &#0128514 &#1000000; &#1114109;|&#1114111;|&#1114112; &copyx &bogus; &#xD800; &#150;"
# Valences and modifiers given to frequent corpus words (fixed values).
CORPUS_VALENCES = {
    "erst": 1.9, "thing": 2.3, "ther": -1.4, "than": 0.8, "thin": -2.1, "eres": -0.9, "erin": 1.1,
    "nicht": -0.7, "avec": 1.3, "para": 0.6, "tion": -1.7, "pour": -0.4,
}
CORPUS_BOOSTERS = {"with": 0.293, "from": -0.293, "sur": 0.293}
CORPUS_NEGATORS = ("by", "mit", "dans")

LEXICON = Lexicon(
    valences=starter_valences() | CORPUS_VALENCES,
    boosters=boosters() | CORPUS_BOOSTERS,
    negators=SENTIMENT_NEGATORS + CORPUS_NEGATORS,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _with_phrase(frame: DataFrame, phrases: dict[str, str], lang: str) -> DataFrame:
    added: Column = F.lit("")
    for code, phrase in phrases.items():
        added = F.when(F.col(lang) == code, F.lit(phrase)).otherwise(added)
    return frame.withColumn("text", F.concat("text", added))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def marked_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _with_phrase(corpus_from_tables(documents(spark, folder)), MARK_PHRASES, "location")


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_from_tables(documents(spark, folder), table(spark, folder, "labels"))


def marked_features(spark: SparkSession, folder: str) -> DataFrame:
    return add_features(_with_phrase(corpus(spark, folder), MARK_PHRASES, "location"))


def all_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features of every document; the label is null where there is none."""
    return add_features(_with_phrase(partly_labelled(spark, folder), MARK_PHRASES, "location"))


def all_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    return add_sentiment(_with_phrase(partly_labelled(spark, folder), SENTIMENT_PHRASES, "location"), LEXICON)


def labels_and_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and every label, also where one lacks the other."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("target"))
    return corpus_from_tables(documents(spark, folder)).join(labels, "id", "full")


def clean_corpus(spark: SparkSession, folder: str) -> DataFrame:
    return add_clean_text(corpus(spark, folder))


def sentiment_corpus(spark: SparkSession, folder: str) -> DataFrame:
    return add_sentiment(_with_phrase(corpus(spark, folder), SENTIMENT_PHRASES, "location"), LEXICON)


def sentiment_and_clean(spark: SparkSession, folder: str) -> DataFrame:
    return add_sentiment(add_clean_text(corpus(spark, folder)), LEXICON)


def partly_labelled(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("target"))
    return corpus_from_tables(documents(spark, folder)).join(labels, "id", "left")


def rounded(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Fractions are compared to six digits; adding zero turns -0.0 into 0.0."""
    return frame.select(
        *[
            (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
            if f.dataType.typeName() == "double"
            else F.col(f.name)
            for f in frame.schema.fields
        ]
    )


# ------------------------------------------------------------------- column functions
def entities(spark: SparkSession, folder: str) -> DataFrame:
    plain = reuse(("entities", "html"), lambda: unescape_html(F.col("html")))
    pages = spread(table(spark, folder, "pages"), "page_id")
    pages = pages.withColumn("html", F.concat("html", F.lit(REFERENCES))).withColumn("plain", plain)
    return pages.select("page_id", F.length("plain").alias("plain_chars"), F.md5("plain").alias("plain_md5"))


def contractions(spark: SparkSession, folder: str) -> DataFrame:
    return marked_documents(spark, folder).select("id", expand_contractions(F.col("text")).alias("expanded"))


def classification_text(spark: SparkSession, folder: str) -> DataFrame:
    return add_clean_text(marked_documents(spark, folder)).select("id", "clean_text")


def sentiment_text(spark: SparkSession, folder: str) -> DataFrame:
    frame = marked_documents(spark, folder)
    return frame.select("id", clean_for_sentiment(F.col("text")).alias("sentiment_text"))


def markers(spark: SparkSession, folder: str) -> DataFrame:
    columns = surface_markers(F.col("text"))
    return marked_documents(spark, folder).select("id", *[c.alias(n) for n, c in columns.items()])


def page_url_markers(spark: SparkSession, folder: str) -> DataFrame:
    columns = surface_markers(F.col("url"))
    return table(spark, folder, "pages").select("page_id", *[c.alias(n) for n, c in columns.items()])


def lengths(spark: SparkSession, folder: str) -> DataFrame:
    frame = add_clean_text(marked_documents(spark, folder))
    columns = length_features(F.col("text"), F.col("clean_text"))
    return rounded(frame.select("id", *[c.alias(n) for n, c in columns.items()]))


def shouting(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return rounded(
        marked_documents(spark, folder).select(
            "id",
            uppercase_percent(text).alias("uppercase_pct"),
            most_repeated_token(text).alias("max_token_repeats"),
            contains_negation(text).alias("contains_negation"),
        )
    )


def decoded_keywords(spark: SparkSession, folder: str) -> DataFrame:
    keyword = F.concat("source", F.lit("%20"), "lang", F.lit("+%C3%A9"))
    return documents(spark, folder).select(
        F.col("doc_id").alias("id"), decode_percent(keyword).alias("keyword_decoded")
    )


# --------------------------------------------------------------------------- sentiment
def scored_documents(spark: SparkSession, folder: str) -> DataFrame:
    frame = _with_phrase(corpus_from_tables(documents(spark, folder)), SENTIMENT_PHRASES, "location")
    return frame.select("id", clean_for_sentiment(F.col("text")).alias("sentiment_text"))


def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = reuse(
        ("counts", "sentiment_text", LEXICON),
        lambda: sentiment_word_counts(F.col("sentiment_text"), LEXICON),
    )
    return scored_documents(spark, folder).select("id", counts.alias("c")).select("id", "c.*")


def polarity(spark: SparkSession, folder: str) -> DataFrame:
    scores = reuse(
        ("polarity", "sentiment_text", LEXICON), lambda: polarity_scores(F.col("sentiment_text"), LEXICON)
    )
    return scored_documents(spark, folder).select("id", scores.alias("p")).select("id", "p.*")


def sentiment_labels(spark: SparkSession, folder: str) -> DataFrame:
    frame = all_sentiment(spark, folder)
    return frame.select("id", "sentiment_compound", "sentiment_label", "negativity", "token_count")


# ------------------------------------------------------------------------------ models
def weighted_split(spark: SparkSession, folder: str) -> tuple[TfidfModel, DataFrame]:
    split = stratified_split(stored(clean_corpus(spark, folder).select("id", "target", "clean_text"), "corpus"))
    model = TfidfModel.fit(split.where(F.col("split") == TRAIN))
    return model, weighted(model, split)


def aggregated_models(spark: SparkSession, folder: str) -> tuple[list[FittedModel], DataFrame]:
    """The two classifiers that are plain aggregations, and the weighted split."""
    model, rows = weighted_split(spark, folder)
    names = (BASELINE_MODEL, NAIVE_BAYES_MODEL)
    fitted = fit_models(rows.where(F.col("split") == TRAIN), model.size, names)
    return list(fitted.values()), rows


def aggregated_predictions(spark: SparkSession, folder: str) -> DataFrame:
    models, rows = aggregated_models(spark, folder)
    return predictions(rows.where(F.col("split") == TEST), models, decimals=9)


def tfidf_weights(spark: SparkSession, folder: str) -> DataFrame:
    model, rows = weighted_split(spark, folder)
    return rounded(long_weights(rows, model))


def majority(spark: SparkSession, folder: str) -> DataFrame:
    split = stratified_split(corpus(spark, folder))
    constant = majority_probability(split.where(F.col("split") == TRAIN))
    return split.where(F.col("split") == TEST).select("id", F.col("target").alias("actual"), F.lit(constant).alias("probability"))


def naive_bayes(spark: SparkSession, folder: str) -> DataFrame:
    scored = aggregated_predictions(spark, folder).where(F.col("model") == NAIVE_BAYES_MODEL)
    return rounded(scored.select("id", "actual", "predicted", "probability"))


def selected(spark: SparkSession, folder: str, tolerance: float = F1_TOLERANCE) -> DataFrame:
    metrics = evaluation.model_metrics(aggregated_predictions(spark, folder))
    return evaluation.select_model(metrics, tolerance)


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    scored = aggregated_predictions(spark, folder).where(F.col("model") == NAIVE_BAYES_MODEL)
    texts = corpus(spark, folder).select("id", "keyword", "text")
    joined = scored.join(texts, "id", "left")
    # Texts are cleaned and scored after the join, for the validation rows only.
    context = add_sentiment(add_clean_text(joined), LEXICON)
    return evaluation.with_outcome(context)


def numeric_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Validation rows of a logistic regression on the negativity score, over the same split."""
    scores = stored(add_sentiment(corpus(spark, folder), LEXICON).select("id", "target", "negativity"), "negativity")
    split = stratified_split(scores)
    found = fit_reweighted(split.where(F.col("split") == TRAIN), ["negativity"])
    probability = F.round(sigmoid(F.lit(found[INTERCEPT]) + found["negativity"] * F.col("negativity")), 9)
    return split.where(F.col("split") == TEST).select(
        "id", F.lit(MODEL_B).alias("model"), F.col("target").alias("actual"),
        predicted_label(probability).alias("predicted"), probability.alias("probability"),
    )


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    first = materialise(evaluation.model_metrics(aggregated_predictions(spark, folder)))
    second = evaluation.model_metrics(materialise(numeric_predictions(spark, folder)))
    return rounded(evaluation.model_catalogue(first, second, [MODEL_B]))


def trained_metrics(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    return rounded(evaluate_models(clean_corpus(spark, folder), names).metrics)


def negativity_experiment(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(differences(compare_negativity(sentiment_and_clean(spark, folder))))


def label_classifier(spark: SparkSession, folder: str) -> TextClassifier:
    """Naive Bayes over all labelled documents; vocabulary and weights read one stored cleaning."""
    train = stored(clean_corpus(spark, folder).select("id", "target", "clean_text"), "training")
    vectoriser = TfidfModel.fit(train)
    fitted = fit_models(weighted(vectoriser, train), vectoriser.size, [NAIVE_BAYES_MODEL])
    return TextClassifier(vectoriser, fitted[NAIVE_BAYES_MODEL])


def score_unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    """Train on the labelled documents, score all others."""
    classifier = label_classifier(spark, folder)
    texts = unlabelled_documents(documents(spark, folder), table(spark, folder, "labels"))
    return rounded(rounded(classifier.score(texts.select("id", "text"), LEXICON).drop("text"), 9))


def streamed_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The same scores from a stream over the documents' files."""
    classifier = label_classifier(spark, folder)
    known = table(spark, folder, "labels").select(F.col("doc_id").alias("id"))
    source = table(spark, folder, "documents").schema
    # As a pattern the path may be one file or a folder of files.
    stream = read_text_stream(spark, f"{folder}/documents.parque[t]", source)

    def unlabelled(batch: DataFrame) -> DataFrame:
        return batch.select(F.col("doc_id").alias("id"), "text").join(known, "id", "left_anti")

    path = shared_path(spark, "stream")
    score_in_batches(stream, classifier, f"{path}/out", f"{path}/state", LEXICON, unlabelled).awaitTermination()
    shape = classifier.score(unlabelled(table(spark, folder, "documents").limit(0)), LEXICON).schema
    return rounded(rounded(read_batches(spark, f"{path}/out", shape).drop("text"), 9))


def logistic_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    """Quality from text length and word variety, by reweighted least squares."""
    length = F.ln(1 + F.col("char_count")).alias("log_chars")
    rows = stored(marked_features(spark, folder).select("target", length, "unique_word_ratio"), "reweighted")
    found = fit_reweighted(rows, ["log_chars", "unique_word_ratio"])
    return rounded(spark.createDataFrame(list(found.items()), "term string, coefficient double"))


def checked_intervals(frame: DataFrame, metrics: list[str], resamples: int) -> DataFrame:
    """What is determined about bootstrap intervals: they hold the observed differences, and those of the means are
    as wide as normal theory says, up to the noise of the resampling."""
    frame = stored(frame, "contrast")
    spreads = [F.var_samp(F.when(F.col("target") == k, F.col(m))) / F.count(F.when(F.col("target") == k, F.col(m))) for m in metrics for k in (1, 0)]
    errors = [float(v) for v in frame.agg(*spreads).first()]
    normal = F.lit(None).cast("double")
    for at, metric in enumerate(metrics):
        normal = F.when(F.col("metric") == metric, 2 * 1.959963985 * (errors[2 * at] + errors[2 * at + 1]) ** 0.5).otherwise(normal)
    found = contrast.compare_groups(frame, metrics, resamples=resamples)
    width = (F.col("mean_ci_high") - F.col("mean_ci_low")) / normal
    return found.select(
        "metric", "n_group_1", "n_group_0", "mean_difference", "median_difference",
        F.col("mean_difference").between(F.col("mean_ci_low"), F.col("mean_ci_high")).alias("mean_inside"),
        F.col("median_difference").between(F.col("median_ci_low"), F.col("median_ci_high")).alias("median_inside"),
        width.between(0.8, 1.25).alias("width_as_expected"),
    )


def registry() -> dict[str, Query]:
    sentiment_metrics = ("negativity", "sentiment_negative", "sentiment_compound")

    def click_or_purchase(spark: SparkSession, folder: str) -> DataFrame:
        kind = F.col("event_type")
        flag = F.when(kind == "click", 1).when(kind == "purchase", 0)
        chosen = table(spark, folder, "events").where(kind.isin("click", "purchase"))
        return chosen.select(flag.alias("target"), "value")

    def returned(spark: SparkSession, folder: str) -> DataFrame:
        flag = F.col("l_returnflag")
        return table(spark, folder, "lineitem").where(flag.isin("R", "N")).select(
            F.when(flag == "R", 1).when(flag == "N", 0).alias("target"), "l_extendedprice", "l_quantity"
        )

    def grams(n: int) -> Query:
        return lambda s, d: rounded(ngrams.ngram_frequencies(clean_corpus(s, d), (n,), top_k=50))

    return {
        "validate_corpus": lambda s, d: validation.corpus_checks(labels_and_texts(s, d)),
        "duplicate_rows": lambda s, d: validation.duplicate_rows(documents(s, d).select("text", "lang", "source")),
        "schema_profile": lambda s, d: rounded(validation.schema_profile(partly_labelled(s, d))),
        "null_rates": lambda s, d: rounded(validation.null_rates(partly_labelled(s, d))),
        "html_entities": entities,
        "contractions": contractions,
        "clean_classification": classification_text,
        "clean_sentiment": sentiment_text,
        "surface_markers": markers,
        "page_url_markers": page_url_markers,
        "length_features": lengths,
        "uppercase_repeat_negation": shouting,
        "decoded_keywords": decoded_keywords,
        "label_distribution": lambda s, d: rounded(reports.label_distribution(partly_labelled(s, d))),
        "features_by_class": lambda s, d: rounded(reports.features_by_class(marked_features(s, d))),
        "cleaning_audit": lambda s, d: rounded(reports.cleaning_audit(all_features(s, d))),
        "before_after_examples": lambda s, d: reports.before_after_examples(all_features(s, d)),
        "marker_rates": lambda s, d: rounded(reports.marker_rates(marked_features(s, d))),
        "top_keywords": lambda s, d: reports.top_keywords(corpus(s, d)),
        "unigrams": grams(1),
        "bigrams": grams(2),
        "trigrams": grams(3),
        "discriminative_terms": lambda s, d: rounded(ngrams.discriminative_terms(clean_corpus(s, d))),
        "stopword_audit": lambda s, d: rounded(ngrams.stop_word_audit(corpus(s, d))),
        "cloud_weights": lambda s, d: rounded(ngrams.cloud_weights(clean_corpus(s, d))),
        "sentiment_word_counts": word_counts,
        "polarity_scores": polarity,
        "sentiment_labels": sentiment_labels,
        "sentiment_by_class": lambda s, d: rounded(reports.sentiment_by_class(sentiment_corpus(s, d))),
        "sentiment_observed": lambda s, d: rounded(reports.sentiment_observed(sentiment_corpus(s, d))),
        "sentiment_global": lambda s, d: rounded(reports.sentiment_global(all_sentiment(s, d))),
        "sentiment_stats": lambda s, d: rounded(reports.sentiment_statistics(sentiment_corpus(s, d))),
        "sentiment_mean_words": lambda s, d: rounded(reports.mean_sentiment_words(sentiment_corpus(s, d))),
        "extreme_docs": lambda s, d: reports.tagged_extremes(all_sentiment(s, d)),
        "extremes_composition": lambda s, d: reports.extremes_composition(all_sentiment(s, d)),
        "extremes_patterns": lambda s, d: rounded(reports.extremes_patterns(all_sentiment(s, d))),
        "negativity_audit": lambda s, d: rounded(contrast.negativity_audit(all_sentiment(s, d)), 9),
        "negativity_ranges": lambda s, d: rounded(reports.negativity_ranges(sentiment_corpus(s, d))),
        "mann_whitney": lambda s, d: rounded(contrast.mann_whitney(click_or_purchase(s, d), ["value"])),
        "cliffs_delta": lambda s, d: rounded(
            contrast.cliffs_delta(returned(s, d), ["l_extendedprice", "l_quantity"])
        ),
        "group_contrast": lambda s, d: rounded(
            contrast.compare_groups(
                sentiment_corpus(s, d), sentiment_metrics, resamples=None, small_domain=True
            )
        ),
        "group_contrast_full": lambda s, d: rounded(
            contrast.compare_groups(sentiment_corpus(s, d), sentiment_metrics, resamples=2_000, small_domain=True)
        ),
        "bootstrap_ci": lambda s, d: rounded(
            contrast.bootstrap_intervals(click_or_purchase(s, d), ["value"], resamples=1_000)
        ),
        "bootstrap_ci_wide": lambda s, d: rounded(
            contrast.bootstrap_intervals(returned(s, d), ["l_extendedprice"], resamples=200)
        ),
        "bootstrap_checked": lambda s, d: rounded(checked_intervals(click_or_purchase(s, d), ["value"], 1_000)),
        "bootstrap_checked_wide": lambda s, d: rounded(
            checked_intervals(returned(s, d), ["l_extendedprice", "l_quantity"], 400)
        ),
        "spearman": lambda s, d: rounded(
            contrast.spearman(table(s, d, "lineitem"), "l_quantity", "l_extendedprice")
        ),
        "stratified_split": lambda s, d: stratified_split(corpus(s, d)).select("id", "target", "split"),
        "split_summary": lambda s, d: rounded(split_summary(stratified_split(corpus(s, d)))),
        "tfidf_weights": tfidf_weights,
        "majority_baseline": majority,
        "complement_nb": naive_bayes,
        "logistic_metrics": lambda s, d: trained_metrics(s, d, ["Regresión logística"]),
        "svm_metrics": lambda s, d: trained_metrics(s, d, ["SVM lineal calibrado"]),
        "confusion_long": lambda s, d: evaluation.confusion_long(aggregated_predictions(s, d)),
        "model_metrics": lambda s, d: rounded(evaluation.model_metrics(aggregated_predictions(s, d))),
        "roc_auc": lambda s, d: rounded(evaluation.roc_auc(aggregated_predictions(s, d))),
        "roc_points": lambda s, d: rounded(evaluation.roc_points(aggregated_predictions(s, d))),
        "ab_differences": lambda s, d: rounded(
            evaluation.metric_differences(
                evaluation.model_metrics(aggregated_predictions(s, d)), BASELINE_MODEL, NAIVE_BAYES_MODEL
            )
        ),
        "negativity_experiment": negativity_experiment,
        "model_catalogue": catalogue,
        "model_selection": selected,
        # A tolerance no model leaves: ROC-AUC decides.
        "model_selection_tied": lambda s, d: selected(s, d, 1.0),
        "error_table": lambda s, d: rounded(evaluation.error_table(outcomes(s, d), per_type=15)),
        "hit_profile": lambda s, d: rounded(evaluation.hit_profile(outcomes(s, d))),
        "errors_by_sentiment": lambda s, d: evaluation.errors_by_sentiment(outcomes(s, d)),
        "score_unlabelled": score_unlabelled,
        "stream_scores": streamed_scores,
        "logistic_coefficients": logistic_coefficients,
        "histogram_by_class": lambda s, d: rounded(
            charts.density_histogram(marked_features(s, d), "char_count", 35)
        ),
        "box_stats": lambda s, d: rounded(charts.box_statistics(marked_features(s, d), "word_count")),
        "ecdf": lambda s, d: rounded(charts.ecdf(sentiment_corpus(s, d), "negativity", small_domain=True)),
        "kde_grid": lambda s, d: rounded(charts.kernel_density(sentiment_corpus(s, d), "sentiment_compound")),
    }
