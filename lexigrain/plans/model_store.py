"""A fitted text classifier: vocabulary, coefficients and how to apply them."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrain.fixed_values import CATEGORY_NAMES
from lexigrain.functions.labelling import negativity_score, sentiment_label
from lexigrain.functions.cleaning import clean_for_sentiment
from lexigrain.functions.expressions import text_or_empty
from lexigrain.functions.polarity import polarity_scores
from lexigrain.operators.features import add_clean_text
from lexigrain.operators.models import FittedModel, predicted_label
from lexigrain.operators.tfidf import TfidfModel
from lexigrain.plans.stages import TermWeightingModel, TextModelModel
from lexigrain.sources.lexicon import Lexicon


@dataclass(frozen=True)
class TextClassifier:
    """Scores raw text: cleaning, weights, probability and sentiment in one projection."""

    vectoriser: TfidfModel
    model: FittedModel
    metadata: dict = field(default_factory=dict)

    def score(
        self, texts: DataFrame, lexicon: Lexicon | None = None, names: dict[int, str] = CATEGORY_NAMES
    ) -> DataFrame:
        """Add clean text, class and probability, with a lexicon also the sentiment.

        Null and empty texts are scored like a document without known terms. Nothing is
        shuffled, so tables and streams take the same path.
        """
        passed = list(texts.columns)
        frame = self.vectoriser.transform(add_clean_text(texts))
        number = None
        if lexicon is not None:
            frame = frame.withColumn(
                "_scores", polarity_scores(clean_for_sentiment(F.col("text")), lexicon)
            )
            compound = F.col("_scores.compound")
            number = negativity_score(compound)
        frame = frame.withColumn("_p", self.model.probability(F.col("weights"), number))
        columns = [
            *[text_or_empty(F.col(c)).alias(c) if c == "text" else F.col(c) for c in passed],
            F.col("clean_text"),
            F.when(predicted_label(F.col("_p")) == 1, F.lit(names[1])).otherwise(F.lit(names[0])).alias("predicted_class"),
            F.col("_p").alias("probability"),
        ]
        if lexicon is not None:
            columns += [
                sentiment_label(compound).alias("sentiment"),
                compound.alias("compound"),
                number.alias("negativity"),
            ]
        return frame.select(*columns)

    def save(self, spark: SparkSession, path: str) -> None:
        """The fitted stages as a Spark ML pipeline under ``path/model``, everything else as one JSON row."""
        pipeline = PipelineModel(stages=[TermWeightingModel(self.vectoriser), TextModelModel(self.model, self.vectoriser.size)])
        pipeline.write().overwrite().save(f"{path}/model")
        text = json.dumps(self.metadata, ensure_ascii=False)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextClassifier:
        weighting, model = PipelineModel.load(f"{path}/model").stages
        metadata = json.loads(spark.read.text(f"{path}/metadata").first().value)
        return cls(weighting.vectoriser, model.fitted, metadata)
