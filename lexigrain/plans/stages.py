"""The models as Spark ML stages: pipelines that can be fitted, tuned, saved and loaded like any other.

``TermWeighting`` learns the vocabulary and adds two columns, the weights of a row as (index, weight) entries and
the same as a sparse vector, which any classifier of Spark ML takes. ``TextModel`` fits one of the
engine's own classifiers on the entries. Fitted stages are written with Spark ML's own metadata and
a Parquet table of terms or coefficients, so a fitted pipeline loads as a ``PipelineModel``.
"""

from __future__ import annotations

from dataclasses import asdict
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol, HasRawPredictionCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrain.fixed_values import (
    BASELINE_MODEL,
    LOGISTIC_C,
    LOGISTIC_MODEL,
    MAX_DOCUMENT_SHARE,
    MAX_ITERATIONS,
    MAX_TERMS,
    MIN_DOCUMENTS,
    MODEL_A,
    MODEL_B,
    NAIVE_BAYES_MODEL,
    NAIVE_BAYES_SMOOTHING,
    SVM_C,
    SVM_MODEL,
)
from lexigrain.operators.models import (
    FittedModel,
    LinearScore,
    fit_logistic,
    fit_majority,
    fit_naive_bayes,
    fit_svm,
    predicted_label,
)
from lexigrain.operators.tfidf import NGRAM_SIZES, TfidfModel, sparse_vector
from lexigrain.session import stored

#: What ``TextModel`` can fit.
MAJORITY, NAIVE_BAYES, LOGISTIC, SVM = "majority", "complement_nb", "logistic", "svm"
_MOST_PROBABLE = 1 - 1e-15


class _Writer(MLWriter):
    """Writes the stage's parameters with ``extra`` metadata, and its table."""

    def __init__(self, stage: Params, table: DataFrame, extra: dict[str, Any]) -> None:
        super().__init__()
        self.stage, self.table, self.extra = stage, table, extra

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata=self.extra)
        self.table.write.parquet(f"{path}/data")


class _Reader(MLReader):
    """Reads a stage's metadata and table and has the class put them together."""

    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> Any:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        # One row per term of a vocabulary that was bounded when it was fitted.
        rows = self.sparkSession.read.parquet(f"{path}/data").orderBy("i").collect()
        stage = self.cls._from_rows(rows, metadata)
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


# -------------------------------------------------------------------------- vocabulary
class _TermColumns(HasInputCol, HasOutputCol):
    vectorCol = Param(Params._dummy(), "vectorCol", "column of sparse vectors", TypeConverters.toString)


class TermWeighting(Estimator, _TermColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the TF-IDF vocabulary of a column of clean text."""

    minDocuments = Param(Params._dummy(), "minDocuments", "documents a term must occur in", TypeConverters.toInt)
    maxDocumentShare = Param(Params._dummy(), "maxDocumentShare", "largest share of documents", TypeConverters.toFloat)
    maxTerms = Param(Params._dummy(), "maxTerms", "size of the vocabulary at most", TypeConverters.toInt)
    sizes = Param(Params._dummy(), "sizes", "words of a term", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCol: str = "clean_text", outputCol: str = "weights", vectorCol: str = "features",
                 minDocuments: int = MIN_DOCUMENTS, maxDocumentShare: float = MAX_DOCUMENT_SHARE,
                 maxTerms: int = MAX_TERMS, sizes: tuple[int, ...] = NGRAM_SIZES) -> None:
        super().__init__()
        self._setDefault(inputCol="clean_text", outputCol="weights", vectorCol="features", minDocuments=MIN_DOCUMENTS,
                         maxDocumentShare=MAX_DOCUMENT_SHARE, maxTerms=MAX_TERMS, sizes=list(NGRAM_SIZES))
        self._set(**{name: list(value) if name == "sizes" else value for name, value in self._input_kwargs.items()})

    def _fit(self, dataset: DataFrame) -> TermWeightingModel:
        get = self.getOrDefault
        vectoriser = TfidfModel.fit(
            dataset, get("inputCol"), get("sizes"), min_df=get("minDocuments"), max_df=get("maxDocumentShare"), max_terms=get("maxTerms")
        )
        return self._copyValues(TermWeightingModel(vectoriser))


class TermWeightingModel(Model, _TermColumns, MLReadable, MLWritable):
    """Adds the weights of a text as entries and as a sparse vector."""

    def __init__(self, vectoriser: TfidfModel | None = None) -> None:
        super().__init__()
        self._setDefault(inputCol="clean_text", outputCol="weights", vectorCol="features")
        self.vectoriser = vectoriser

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weighted = self.vectoriser.transform(dataset, self.getOrDefault("inputCol"), self.getOrDefault("outputCol"))
        return weighted.withColumn(self.getOrDefault("vectorCol"), sparse_vector(F.col(self.getOrDefault("outputCol")), self.vectoriser.size))

    def write(self) -> _Writer:
        rows = list(zip(range(self.vectoriser.size), self.vectoriser.terms, self.vectoriser.idf))
        writer = _Writer(self, None, {"sizes": list(self.vectoriser.sizes)})
        writer.table = writer.sparkSession.createDataFrame(rows, "i int, term string, idf double")
        return writer

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)

    @classmethod
    def _from_rows(cls, rows: list, metadata: dict) -> TermWeightingModel:
        return cls(TfidfModel(tuple(r.term for r in rows), tuple(r.idf for r in rows), tuple(metadata["sizes"])))


# ------------------------------------------------------------------------- classifiers
class _ModelColumns(HasLabelCol, HasPredictionCol, HasRawPredictionCol):
    weightsCol = Param(Params._dummy(), "weightsCol", "column of (index, weight) entries", TypeConverters.toString)
    numericCol = Param(Params._dummy(), "numericCol", "column of the extra number, empty for none", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "column of the probability of class 1", TypeConverters.toString)

    def _column_defaults(self) -> None:
        self._setDefault(labelCol="target", predictionCol="prediction", rawPredictionCol="rawPrediction",
                         weightsCol="weights", numericCol="", probabilityCol="probability")


class TextModel(Estimator, _ModelColumns, DefaultParamsReadable, DefaultParamsWritable):
    """One of the engine's classifiers over the entries of ``TermWeighting``."""

    algorithm = Param(Params._dummy(), "algorithm", f"{MAJORITY}, {NAIVE_BAYES}, {LOGISTIC} or {SVM}", TypeConverters.toString)
    terms = Param(Params._dummy(), "terms", "size of the vocabulary; 0 reads it off the entries", TypeConverters.toInt)
    c = Param(Params._dummy(), "c", "inverse strength of the penalty; 0 takes the classifier's own", TypeConverters.toFloat)
    smoothing = Param(Params._dummy(), "smoothing", "of naive Bayes", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations at most", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "column whose hash deals rows to calibration folds", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, algorithm: str = LOGISTIC, labelCol: str = "target", weightsCol: str = "weights", numericCol: str = "",
                 terms: int = 0, c: float = 0.0, smoothing: float = NAIVE_BAYES_SMOOTHING, maxIter: int = MAX_ITERATIONS,
                 idCol: str = "id") -> None:
        super().__init__()
        self._column_defaults()
        self._setDefault(algorithm=LOGISTIC, terms=0, c=0.0, smoothing=NAIVE_BAYES_SMOOTHING, maxIter=MAX_ITERATIONS, idCol="id")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TextModelModel:
        get = self.getOrDefault
        algorithm, numeric = get("algorithm"), get("numericCol") or None
        wanted = {"target": get("labelCol"), "weights": get("weightsCol"), **({"number": numeric} if numeric else {})}
        if algorithm == SVM:
            wanted["id"] = get("idCol")
        rows = stored(dataset.select(*[F.col(name).alias(alias) for alias, name in wanted.items()]), "stage")
        size = get("terms") or 1 + (rows.agg(F.max(F.array_max(F.transform("weights", lambda entry: entry["i"])))).first()[0] or 0)
        if algorithm == MAJORITY:
            fitted = fit_majority(rows)
        elif algorithm == NAIVE_BAYES:
            fitted = fit_naive_bayes(rows, size, smoothing=get("smoothing"))
        elif algorithm == LOGISTIC:
            fitted = fit_logistic(rows, size, c=get("c") or LOGISTIC_C, numeric="number" if numeric else None, max_iterations=get("maxIter"))
        elif algorithm == SVM:
            fitted = fit_svm(rows, size, c=get("c") or SVM_C, max_iterations=get("maxIter"))
        else:
            raise ValueError(f"unknown algorithm: {algorithm}")
        return self._copyValues(TextModelModel(fitted, size))


class TextModelModel(Model, _ModelColumns, MLReadable, MLWritable):
    """Adds probability, its logarithmic odds as raw prediction, and the predicted label."""

    def __init__(self, fitted: FittedModel | None = None, size: int = 0) -> None:
        super().__init__()
        self._column_defaults()
        self.fitted, self.size = fitted, size

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        number = F.col(get("numericCol")) if self.fitted.uses_numeric else None
        scored = dataset.withColumn(get("probabilityCol"), self.fitted.probability(F.col(get("weightsCol")), number))
        p = F.least(F.greatest(F.col(get("probabilityCol")), F.lit(1 - _MOST_PROBABLE)), F.lit(_MOST_PROBABLE))
        return scored.withColumn(get("rawPredictionCol"), F.ln(p / (1 - p))).withColumn(
            get("predictionCol"), predicted_label(F.col(get("probabilityCol"))).cast("double")
        )

    def write(self) -> _Writer:
        scores = self.fitted.scores
        rows = [(i, [float(score.coefficients[i]) for score in scores]) for i in range(self.size if scores else 0)]
        extra = {
            "size": self.size,
            "model": {k: v for k, v in asdict(self.fitted).items() if k != "scores"},
            "scores": [{k: v for k, v in asdict(score).items() if k != "coefficients"} for score in scores],
        }
        writer = _Writer(self, None, extra)
        writer.table = writer.sparkSession.createDataFrame(rows, "i int, coefficients array<double>")
        return writer

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)

    @classmethod
    def _from_rows(cls, rows: list, metadata: dict) -> TextModelModel:
        scores = [LinearScore([r.coefficients[k] for r in rows], **values) for k, values in enumerate(metadata["scores"])]
        return cls(FittedModel(scores=scores, **metadata["model"]), metadata["size"])


def text_pipeline(algorithm: str, numeric: str = "", **settings: Any) -> Pipeline:
    """Vocabulary and classifier as one estimator."""
    return Pipeline(stages=[TermWeighting(), TextModel(algorithm=algorithm, numericCol=numeric, **settings)])


def pipeline_registry() -> dict[str, Pipeline]:
    """The four comparable classifiers as pipelines, by name."""
    names = {BASELINE_MODEL: MAJORITY, NAIVE_BAYES_MODEL: NAIVE_BAYES, LOGISTIC_MODEL: LOGISTIC, SVM_MODEL: SVM}
    return {name: text_pipeline(algorithm) for name, algorithm in names.items()}


def negativity_pipelines() -> dict[str, Pipeline]:
    """The logistic regression without and with the negativity score."""
    return {MODEL_A: text_pipeline(LOGISTIC), MODEL_B: text_pipeline(LOGISTIC, numeric="negativity")}

