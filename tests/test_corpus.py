"""Validation, sources, sinks, n-grams and the driver contract."""

import json

import pytest

import __spark_entry__ as contract
from lexigrain.operators import ngrams, validation
from lexigrain.operators.features import add_features, add_sentiment
from lexigrain.operators.reports import extreme_documents, sentiment_by_class, threshold_catalogue
from lexigrain.sources.corpus import read_corpus_csv
from lexigrain.sources.lexicon import Lexicon
from lexigrain.sources.sinks import write_frame, write_table

SCHEMA = "id long, keyword string, location string, text string, target int"


def test_validation(spark):
    good = spark.createDataFrame([(1, "fire", None, "Forest fire", 1), (2, None, "Guatemala", "Movie", 0)], SCHEMA)
    validation.validate_corpus(good)
    with pytest.raises(ValueError):
        validation.validate_corpus(spark.createDataFrame([(1, None, None, "x", 2)], SCHEMA))
    with pytest.raises(ValueError, match="missing columns"):
        validation.validate_corpus(good.drop("text"))
    doubled = good.unionAll(good)
    assert validation.duplicate_rows(doubled).first().duplicate_rows == 2
    with pytest.raises(ValueError, match="duplicate_ids=2"):
        validation.validate_corpus(doubled)


def test_csv_round_trip(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        'id,keyword,location,text,target\n1,,NA,"two\nlines, ""quoted""",1\n2,a%20b,null,plain,0\n', encoding="utf-8"
    )
    frame = read_corpus_csv(spark, str(tmp_path / "in.csv"))
    rows = frame.orderBy("id").collect()
    assert (rows[0].keyword, rows[0].location, rows[0].text) == (None, None, 'two\nlines, "quoted"')
    assert rows[1].keyword == "a%20b" and rows[1].location is None
    write_frame(frame, str(tmp_path / "out"))
    assert read_corpus_csv(spark, str(tmp_path / "out")).orderBy("id").collect() == rows
    write_table(threshold_catalogue(spark), str(tmp_path / "rules"))
    assert spark.read.option("header", True).csv(str(tmp_path / "rules")).count() == 3


def test_ngrams(spark):
    frame = spark.createDataFrame([(1, "fire near city", 1), (2, "city fire", 1)], "id long, clean_text string, target int")
    table = ngrams.ngram_frequencies(frame, (1,), top_k=None).collect()
    assert sum(r.frequency for r in table) == 4 and sum(r.probability for r in table) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        ngrams.require_vocabulary(ngrams.ngram_frequencies(frame, (3,)))


def test_feature_row(spark):
    row = add_features(spark.createDataFrame([(1, "fire", None, "No #fire!", 1)], SCHEMA)).first()
    assert (row.clean_text, row.char_count, row.word_count) == ("no", 9, 2)
    assert (row.keyword_present, row.location_present) == (1, 0)


def test_sentiment_frame(spark):
    texts = [
        ("Terrible earthquake destroyed the whole town, people are dying", 1),
        ("What a wonderful and happy day, I love everything :)", 0),
        ("The train arrives at nine", 0),
        ("Great concert last night, amazing show!", 0),
    ]
    corpus = spark.createDataFrame([(i, None, None, t, y) for i, (t, y) in enumerate(texts)], SCHEMA)
    frame = add_sentiment(corpus, Lexicon())
    assert [r.sentiment_label for r in frame.orderBy("id").collect()] == ["negativo", "positivo", "neutral", "positivo"]
    shares = {}
    for row in sentiment_by_class(frame).collect():
        shares[row.target] = shares.get(row.target, 0) + row.percent
    assert shares == {0: pytest.approx(100), 1: pytest.approx(100)}
    best, worst = (part.collect() for part in extreme_documents(frame, 3))
    assert [r.sentiment_compound for r in best] == sorted((r.sentiment_compound for r in best), reverse=True)
    assert worst[0].id == 0 and len(worst) == 3


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    frame = contract.entry(spark)
    assert frame.columns == ["target", "n", "ngram", "frequency", "probability"]
    assert json.dumps(sorted(contract.queries()))
