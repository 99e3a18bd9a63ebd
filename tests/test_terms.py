"""Term counts and weights from Arrow batches against the expressions over every word."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexigrain.functions import terms
from lexigrain.functions.expressions import ngram_range, run_lengths, text_or_empty, word_tokens
from lexigrain.operators.tfidf import TfidfModel

LETTERS = list("ab_9 .,'\t\n\x00-éßİKα١²½ªΣ中😂́﻿\xa0 ")


@pytest.fixture(scope="module")
def odd(spark):
    """Texts of odd letters, some of them null, empty or equal."""
    draw = np.random.default_rng(1)
    texts = [None, "", "a", "aa bb aa", "aa bb aa"] + ["".join(draw.choice(LETTERS, n)) for n in draw.choice([1, 3, 30, 200], 200)]
    return spark.createDataFrame([*enumerate(texts)], "id long, t string").repartition(3, "id")


def word_by_word(sizes):
    return run_lengths(ngram_range(word_tokens(F.lower(text_or_empty(F.col("t")))), sizes))


@pytest.mark.parametrize("sizes", [(1,), (1, 2), (2,), (1, 3)])
def test_counts_equal_the_expression(odd, sizes):
    runs = odd.select(F.inline(word_by_word(sizes))).groupBy("term").agg(F.sum("tf"), F.count(F.lit(1)))
    counts = terms.term_counts(odd, "t", sizes).groupBy("term").agg(F.sum("tf"), F.sum("documents"))
    found = {term: numbers for term, *numbers in counts.collect()}
    assert found.pop(None) == [odd.count()] * 2
    assert found == {term: numbers for term, *numbers in runs.collect()}


def test_weights_equal_the_definition(odd):
    model = TfidfModel.fit(odd, "t", (1, 2), min_df=1, max_df=0.9, max_terms=300)
    at = {term: i for i, term in enumerate(model.terms)}
    found = {r.id: [tuple(e) for e in r.weights] for r in model.transform(odd, "t").collect()}
    for row in odd.select("id", word_by_word((1, 2)).alias("runs")).collect():
        raw = {at[r.term]: (1 + np.log(r.tf)) * model.idf[at[r.term]] for r in row.runs if r.term in at}
        norm = np.sqrt(sum(w * w for w in raw.values()))
        assert [i for i, _ in found[row.id]] == sorted(raw)
        assert [w for _, w in found[row.id]] == pytest.approx([raw[i] / norm for i in sorted(raw)])


def test_cuts_between_chunks_change_nothing(monkeypatch):
    texts = pa.array(["aa bb", "", "bb aa bb aa", "cc " * 50, "aa"]).slice(1)
    index = terms.TermIndex(["aa", "aa bb", "cc cc"], [1.0, 2.0, 3.0], (1, 2))
    whole = pa.concat_arrays(map(index.weights, terms.chunks(texts)))
    monkeypatch.setattr(terms, "CHUNK_BYTES", 8)
    cuts = [len(chunk) for chunk in terms.chunks(texts)]
    assert len(cuts) > 1 and sum(cuts) == 4
    assert pa.concat_arrays(map(index.weights, terms.chunks(texts))) == whole
    assert [len(entries) for entries in whole.to_pylist()] == [0, 2, 1, 1]


def test_no_word_is_visited_by_an_expression(odd):
    # Texts reach the counting and weighting whole: word by word they took most of the time of the model queries.
    model = TfidfModel.fit(odd, "t", (1, 2), min_df=1, max_df=0.9, max_terms=300)
    for frame in (model.transform(odd, "t"), terms.term_counts(odd, "t", (1, 2))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert ("Arrow" in plan) and "array_sort" not in plan and "sort_array" not in plan and "crc32" not in plan
