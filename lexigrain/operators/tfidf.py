"""TF-IDF: a bounded vocabulary fitted with one shuffle, applied without any."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrain.fixed_values import MAX_DOCUMENT_SHARE, MAX_TERMS, MIN_DOCUMENTS
from lexigrain.functions.expressions import literal_array, reuse
from lexigrain.functions.terms import WEIGHTS_TYPE, term_counts, term_weights
from lexigrain.session import stored

NGRAM_SIZES = (1, 2)


def vocabulary(
    train: DataFrame,
    sizes: Sequence[int] = NGRAM_SIZES,
    min_df: int = MIN_DOCUMENTS,
    max_df: float = MAX_DOCUMENT_SHARE,
    max_terms: int = MAX_TERMS,
    text: str = "clean_text",
) -> DataFrame:
    """``term, corpus_count, documents, idf`` of the commonest terms; at most ``max_terms`` rows."""
    # Documents are also counted, under a null term, so n comes out of the same pass.
    counts = (
        term_counts(train, text, sizes)
        .groupBy("term")
        .agg(F.sum("tf").alias("corpus_count"), F.sum("documents").alias("documents"))
    )
    held = stored(counts.where((F.col("documents") >= min_df) | F.col("term").isNull()), "vocabulary")
    n = (held.where(F.col("term").isNull()).first() or {"documents": 0})["documents"]
    kept = held.where(F.col("term").isNotNull() & (F.col("documents") <= max_df * n))
    top = kept.orderBy(F.desc("corpus_count"), "term").limit(max_terms)
    return top.withColumn("idf", F.ln((1 + n) / (1 + F.col("documents"))) + 1)


@dataclass(frozen=True, eq=False)
class TfidfModel:
    """Terms in alphabetical order with their inverse document frequencies."""

    terms: tuple[str, ...]
    idf: tuple[float, ...]
    sizes: tuple[int, ...] = NGRAM_SIZES

    @classmethod
    def fit(cls, train: DataFrame, text: str = "clean_text", sizes: Sequence[int] = NGRAM_SIZES, **limits) -> TfidfModel:
        table = vocabulary(train, sizes, text=text, **limits)
        rows = sorted((row.term, row.idf) for row in table.select("term", "idf").collect())
        if not rows:
            raise ValueError("empty vocabulary: no term reaches the document threshold")
        return cls(tuple(t for t, _ in rows), tuple(w for _, w in rows), tuple(sizes))

    @property
    def size(self) -> int:
        return len(self.terms)

    def weights(self, text: Column) -> Column:
        """Normalised weights of a text as an array of (term index, weight), in index order."""
        return term_weights(text, self.terms, self.idf, self.sizes)

    def transform(self, frame: DataFrame, text: str = "clean_text", output: str = "weights") -> DataFrame:
        column = reuse(("tfidf", text, self), lambda: self.weights(F.col(text)))
        return frame.withColumn(output, column)


def entries_of(column: str) -> Column:
    """Array column to explode. Exploding a bare column makes the optimiser add a filter on
    its size, pushed below the projection that computes it, at twice the work."""
    return F.coalesce(F.col(column), F.array().cast(WEIGHTS_TYPE))


def long_weights(frame: DataFrame, model: TfidfModel, key: str = "id") -> DataFrame:
    """``id, term, weight`` of a frame with a weights column."""
    terms = literal_array(model.terms, "string")
    return frame.select(key, F.explode(entries_of("weights")).alias("_x")).select(
        key, F.get(terms, F.col("_x.i")).alias("term"), F.col("_x.w").alias("weight")
    )


_VECTOR_ROW = T.StructType([T.StructField("v", VectorUDT())])


def sparse_vector(weights: Column, size: int) -> Column:
    """Sparse ML vector from (index, weight) pairs, built inside the JVM.

    Going through JSON is the one built-in way from a plain struct to a vector; numbers
    survive it unchanged, and no Python worker is started.
    """
    plain = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        F.transform(weights, lambda entry: entry["i"]).alias("indices"),
        F.transform(weights, lambda entry: entry["w"]).alias("values"),
    )
    return F.from_json(F.to_json(F.struct(plain.alias("v"))), _VECTOR_ROW)["v"]

