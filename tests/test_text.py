"""Cleaning, markers and sentiment on hand-made texts."""

import html

import pytest
from pyspark.sql import functions as F

from lexigrain.fixed_values import DEMO_TEXTS_FINAL, STOP_WORDS
from lexigrain.functions import labelling, markers
from lexigrain.functions.cleaning import clean_for_classification, clean_for_sentiment, expand_contractions
from lexigrain.functions.entities import unescape_html
from lexigrain.functions.expressions import count_words
from lexigrain.functions.lookup import found_words
from lexigrain.functions.polarity import polarity_scores, sentiment_word_counts
from lexigrain.sources.lexicon import Lexicon, read_lexicon


def column(spark, texts, expression):
    rows = [(i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "i int, text string")
    return [r.x for r in frame.select("i", expression.alias("x")).orderBy("i").collect()]


def raw():
    return F.col("text")


def test_stop_word_list_has_its_known_size():
    assert len(STOP_WORDS) == 318
    assert "not" not in STOP_WORDS and "fire" in STOP_WORDS


def test_entities_follow_the_standard_library(spark):
    texts = [
        "&amp;lt; &lt; &notit; &#128514; &#x1F602; &#0; &#150; &#xD800; &#99999999999; &copy &foo; &&&",
        "&#xfdd0;&ampfoo &AMP; &rarr; &Acy;&#1;x &hellip;&#8364 5 &#xFFFE;",
        "&#1000000;&#1048573;&#0001000000; &#1114109;|&#1114111;|&#1114112;|&#xF4240;|&#x10FFFF;|&#x110000;|&#18446744073709551617;",
        "nothing here",
    ]
    assert column(spark, texts, unescape_html(raw())) == [html.unescape(t) for t in texts]


def test_classification_cleaning(spark):
    texts = [
        "I can't ignore #Flood911: call 911! @rescue https://example.org",
        "No #fire!",
        "cross-body é911 won’t nineoneone 12",
        "",
        None,
    ]
    assert column(spark, texts, clean_for_classification(raw())) == [
        "not ignore flood 911",
        "no",
        "crossbody not 911",
        "",
        "",
    ]


def test_sentiment_cleaning_is_light(spark):
    texts = ["I can't believe it! 😢 #Flood @user https://x.test", None]
    assert column(spark, texts, clean_for_sentiment(raw())) == ["I can not believe it! 😢 Flood", ""]


def test_surface_markers(spark):
    frame = spark.createDataFrame([("Help! #fire @911 https://x.test call 911 😢",), (None,)], "text string")
    row, empty = frame.select(*[c.alias(n) for n, c in markers.surface_markers(raw()).items()]).collect()
    assert (row.url_count, row.mention_count, row.hashtag_count, row.exclamation_count) == (1, 1, 1, 1)
    assert row.contains_911 == 1 and row.emoji_like_count == 1 and row.digit_count == 6
    assert set(empty.asDict().values()) == {0}


def test_row_patterns(spark):
    texts = ["a A b a", "", "DON'T never", "don't"]
    assert column(spark, texts, markers.most_repeated_token(raw())) == [3, 0, 1, 1]
    assert column(spark, texts, markers.contains_negation(raw())) == [0, 0, 1, 0]
    assert column(spark, ["a+b%20c", "100%zz"], markers.decode_percent(raw())) == ["a+b c", "100%zz"]


@pytest.mark.parametrize(
    ("compound", "label"),
    [(1.0, "positivo"), (0.05, "positivo"), (0.049, "neutral"), (0.0, "neutral"), (-0.049, "neutral"), (-0.05, "negativo")],
)
def test_sentiment_thresholds(spark, compound, label):
    row = spark.range(1).select(
        labelling.sentiment_label(F.lit(compound)).alias("label"), labelling.negativity_score(F.lit(compound)).alias("n")
    ).first()
    assert row.label == label and 0 <= row.n <= 1


def test_bins_are_closed_on_the_right(spark):
    values = [(0.0,), (0.2,), (0.2001,), (1.0,)]
    frame = spark.createDataFrame(values, "v double").select(labelling.right_closed_bin(F.col("v")).alias("b"))
    assert [r.b for r in frame.collect()] == ["(-0.001, 0.0]", "(0.0, 0.2]", "(0.2, 0.4]", "(0.8, 1.0]"]


def test_published_compound_scores(spark):
    texts = [*DEMO_TEXTS_FINAL, "wreck? " + "wreck " * 11 + "wreck?", ""]
    plain = clean_for_sentiment(raw())
    scores = column(spark, texts, polarity_scores(plain, Lexicon()))
    assert [s.compound for s in scores] == [-0.4003, 0.1494, -0.3818, 0.4793, 0.2732, -0.7845, -0.9883, 0.0]


def test_word_counts_partition_the_tokens(spark):
    texts = ["Terrible fire but the rescue was great", "awful terrible horrible disaster", "wonderful amazing great happy", ""]
    counts = column(spark, texts, sentiment_word_counts(raw(), Lexicon()))
    assert all(c.pos_word_count + c.neg_word_count + c.neu_word_count == c.token_count for c in counts)
    assert [tuple(c)[:2] for c in counts] == [(2, 2), (0, 4), (4, 0), (0, 0)]


def test_words_are_looked_up_once_and_emojis_spelled_in_the_whole_text(spark):
    """Sentiment without counts tokenises a text once; emojis inside, before and after words, unknown signs between."""
    plan = spark.range(1).select(polarity_scores(F.col("id").cast("string"), Lexicon()).alias("s"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("zip_with") < 4 and "flatten" not in plan
    lexicon = Lexicon(valences={"joy": 2.0, "good": 1.5, "face": 0.5}, emojis={"😂": "joy", "😊": "good face", "❤": "joy"})
    texts = ["ok😂", "ok joy", "a😂😊b 😢", "a joy good faceb 😢", "😂", "joy", "x❤️", "x joy️", "no 😊so", "no good faceso"]
    scores = [tuple(s) for s in column(spark, texts, polarity_scores(raw(), lexicon))]
    assert scores[::2] == scores[1::2] and scores[0][0] > 0


def test_only_words_in_reach_of_a_scored_one_are_scored_in_spark(spark):
    """A long text costs the rules as little as its scored words; scores are those of the text cut to them."""
    far = "xx yy zz " * 50
    texts = [f"{far}so not very good ok{far}", "", None, "but a 😂😂 but", f"GOOD {far} kiss of death"]
    found = column(spark, texts, found_words(raw(), Lexicon()))
    assert [f and f.lower for f in found] == [
        ["so", "not", "very", "good", "okxx", "yy"], [], None,
        ["but", "tears", "joy", "tears", "joy"], ["good", "xx", "yy", "zz", "kiss", "of", "death"],
    ]
    assert found[0].token_total == 304 and found[4].mixed_caps and found[3].own_total == 4
    long, short = column(spark, [texts[0], "so not very good okxx yy"], polarity_scores(raw(), Lexicon()))
    assert long.compound == short.compound != 0
    assert column(spark, [None], sentiment_word_counts(raw(), Lexicon()))[0].token_count is None


def test_contractions_by_word(spark):
    texts = ["I won't\tcan’t  DON'T 'we'd' it'll've x'dy n't", " 'm ", "a  b'"]
    expected = ["I will not\tcan not  DO not 'we would' it will have x'dy  not", "  am ", "a  b'"]
    assert column(spark, texts, expand_contractions(raw())) == expected
    plan = spark.range(1).select(expand_contractions(F.col("id").cast("string")).alias("s"))._jdf.queryExecution().analyzed().toString()
    assert "split(" in plan
    assert column(spark, ["a\u2003b  c\n", "", None, " x "], count_words(F.col("text"))) [:2] == [3, 0]


def test_lexicon_files(spark, tmp_path):
    (tmp_path / "words.txt").write_text("good\t1.9\t0.9\t[1]\n:(\t-1.9\t1\t[2]\n\"q\t0.5\t1\t[1]\n", encoding="utf-8")
    (tmp_path / "emojis.txt").write_text("😢\tcrying face\n", encoding="utf-8")
    lexicon = read_lexicon(spark, str(tmp_path / "words.txt"), str(tmp_path / "emojis.txt"))
    assert lexicon.valences == {"good": 1.9, ":(": -1.9, '"q': 0.5} and lexicon.emojis == {"😢": "crying face"}
