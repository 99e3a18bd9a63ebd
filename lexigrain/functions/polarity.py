"""Lexicon sentiment, narrow: a row never leaves its partition.

The published rules look at a scored word and at most three words before and two
after it, so the score of a text is a function of these words, which ``lookup`` finds,
and of a few numbers. The rules are one projection over them.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexigrain.fixed_values import (
    BUT_AFTER,
    BUT_BEFORE,
    CAPS_BOOST,
    DISTANCE_DAMPING,
    EXCLAMATION_LIMIT,
    EXCLAMATION_WEIGHT,
    NEGATION_FACTOR,
    NEVER_FACTOR,
    NORMALISER,
    PUNCTUATION,
    QUESTION_CEILING,
    QUESTION_LIMIT,
    QUESTION_WEIGHT,
)
from lexigrain.functions.expressions import array_sum, bind
from lexigrain.functions.lookup import found_words
from lexigrain.sources.lexicon import Lexicon

SCORES = ("compound", "negative", "neutral", "positive")
COUNTS = ("pos_word_count", "neg_word_count", "neu_word_count", "token_count")


def _is_upper(token: Column, lower: Column) -> Column:
    # Most tokens equal their lower-case form, which settles the test at once.
    return (token != lower) & (F.upper(token) == token)


def _punctuation_emphasis(marks: Column, questions: Column) -> Column:
    exclamations = F.least(marks, F.lit(EXCLAMATION_LIMIT))
    return exclamations * EXCLAMATION_WEIGHT + F.when(questions <= 1, F.lit(0.0)).when(
        questions <= QUESTION_LIMIT, questions * QUESTION_WEIGHT
    ).otherwise(F.lit(QUESTION_CEILING))


class _Context:
    """Token arrays of one row and the rules that look around a scored word."""

    def __init__(self, found: Column, lexicon: Lexicon):
        self.tokens, self.lower, self.valence = found["tokens"], found["lower"], found["valence"]
        self.touched, self.phrased, self.mixed_caps = found["touched"], found["phrased"], found["mixed_caps"]
        self.lexicon = lexicon
        self.last = F.size(self.tokens) - 1
        self._booster = lexicon.booster_table()
        self._idiom = lexicon.idiom_table()

    def word(self, at: Column) -> Column:
        # ``get`` gives null outside the array, and a comparison with null is never true.
        return F.get(self.lower, at)

    def phrase(self, at: Column, first: int, last: int) -> Column:
        inside = (at + first >= 0) & (at + last <= self.last)
        words = [self.word(at + k) for k in range(first, last + 1)]
        return F.when(inside, F.concat_ws(" ", *words))

    def _shifted(self, value: Column, amount: Column) -> Column:
        return F.when(value > 0, value + amount).otherwise(value - amount)

    def starting_value(self, at: Column) -> Column:
        own = F.get(self.valence, at)
        word = self.word(at)
        silent_no = (word == "no") & F.get(self.valence, at + 1).isNotNull()
        after_no = (
            (self.word(at - 1) == "no")
            | (self.word(at - 2) == "no")
            | ((self.word(at - 3) == "no") & self.word(at - 1).isin("or", "nor"))
        )
        return self._loud(at, F.when(after_no, own * NEGATION_FACTOR).when(silent_no, F.lit(0.0)).otherwise(own))

    def _loud(self, at: Column, value: Column) -> Column:
        shouted = _is_upper(F.get(self.tokens, at), self.word(at)) & self.mixed_caps
        return bind(
            value, lambda v: F.when(shouted, self._shifted(v, F.lit(CAPS_BOOST))).otherwise(v)
        )

    def boosted(self, at: Column, distance: int, value: Column) -> Column:
        token = F.get(self.tokens, at - distance)

        def applied(amount: Column) -> Column:
            signed = F.when(value < 0, -amount).otherwise(amount)
            loud = F.when(
                _is_upper(token, self.word(at - distance)) & self.mixed_caps,
                F.when(value > 0, signed + CAPS_BOOST).otherwise(signed - CAPS_BOOST),
            ).otherwise(signed)
            return F.when(amount.isNull(), value).otherwise(
                value + loud * DISTANCE_DAMPING[distance - 1]
            )

        return bind(self._booster(self.word(at - distance)), applied)

    def _negates(self, at: Column) -> Column:
        word = self.word(at)
        return word.isin(list(self.lexicon.negators)) | F.contains(word, F.lit("n't"))

    def negated(self, at: Column, distance: int, value: Column) -> Column:
        before = [None, self.word(at - 1), self.word(at - 2), self.word(at - 3)]
        plain = F.when(self._negates(at - distance), value * NEGATION_FACTOR).otherwise(value)
        if distance == 1:
            return plain
        if distance == 2:
            never = (before[2] == "never") & before[1].isin("so", "this")
            without_doubt = (before[2] == "without") & (before[1] == "doubt")
        else:
            never = ((before[3] == "never") & before[2].isin("so", "this")) | before[1].isin("so", "this")
            without_doubt = (before[3] == "without") & (
                (before[2] == "doubt") | (before[1] == "doubt")
            )
        return F.when(never, value * NEVER_FACTOR).when(without_doubt, value).otherwise(plain)

    def idiomatic(self, at: Column, value: Column) -> Column:
        spans = ((-1, 0), (-2, 0), (-2, -1), (-3, -1), (-3, -2))
        backward = F.coalesce(*[self._idiom(self.phrase(at, *span)) for span in spans])
        forward = F.coalesce(self._idiom(self.phrase(at, 0, 2)), self._idiom(self.phrase(at, 0, 1)))
        out = F.coalesce(forward, backward, value)
        for span in ((-3, -1), (-3, -2), (-2, -1)):
            out = out + F.coalesce(self._booster(self.phrase(at, *span)), F.lit(0.0))
        return out

    def after_least(self, at: Column, value: Column) -> Column:
        hit = (
            (self.word(at - 1) == "least")
            & F.get(self.valence, at - 1).isNull()
            & ~F.coalesce(self.word(at - 2).isin("at", "very"), F.lit(False))
        )
        return F.when(hit, value * NEGATION_FACTOR).otherwise(value)

    def score(self, at: Column) -> Column:
        """Valence of the lexicon word at ``at`` after all rules about its neighbours.

        Most words have no neighbour that any rule names; those are done with at once.
        """
        alone = self._loud(at, F.get(self.valence, at))
        return F.when(F.get(self.touched, at), self._ruled(at)).otherwise(alone)

    def _ruled(self, at: Column) -> Column:
        value = self.starting_value(at)
        for distance in (1, 2, 3):
            value = bind(value, partial(self._step, at, distance))
        value = bind(value, lambda v: self.after_least(at, v))
        is_modifier = self._booster(self.word(at)).isNotNull() | (
            (self.word(at) == "kind") & (self.word(at + 1) == "of")
        )
        return F.when(is_modifier, F.lit(0.0)).otherwise(value)

    def _step(self, at: Column, distance: int, value: Column) -> Column:
        plain_word = (at >= distance) & F.get(self.valence, at - distance).isNull()
        changed = bind(
            self.boosted(at, distance, value), lambda v: self.negated(at, distance, v)
        )
        if distance == 3:
            phrased = F.get(self.phrased, at)
            changed = bind(changed, lambda v: F.when(phrased, self.idiomatic(at, v)).otherwise(v))
        return F.when(plain_word, changed).otherwise(value)


def _hit_scores(found: Column, lexicon: Lexicon) -> Column:
    """Scores of the lexicon words of a text, in order; other words score zero."""
    lower, valence = found["lower"], found["valence"]

    def scored(but: Column) -> Column:
        context = _Context(found, lexicon)
        hits = F.filter(
            F.transform(valence, lambda value, at: F.when(value.isNotNull(), at)),
            lambda at: at.isNotNull(),
        )

        def weighed(at: Column) -> Column:
            share = (
                F.when((but > 0) & (at < but - 1), F.lit(BUT_BEFORE))
                .when((but > 0) & (at > but - 1), F.lit(BUT_AFTER))
                .otherwise(F.lit(1.0))
            )
            return context.score(at) * share

        return F.transform(hits, weighed)

    return bind(F.array_position(lower, "but"), scored)


def _combined(scores: Column, token_total: Column, emphasis: Column) -> Column:
    """Compound score and shares from the scores of the lexicon words."""

    def shares(total: Column, up: Column, down: Column, neutral: Column) -> Column:
        strengthened = (
            F.when(total > 0, total + emphasis).when(total < 0, total - emphasis).otherwise(total)
        )
        compound = bind(
            strengthened,
            lambda s: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s / F.sqrt(s * s + NORMALISER))),
        )
        positive = F.when(up > F.abs(down), up + emphasis).otherwise(up)
        negative = F.when(up < F.abs(down), F.abs(down) + emphasis).otherwise(F.abs(down))
        whole = positive + negative + neutral
        empty = token_total == 0

        def portion(part: Column) -> Column:
            return F.when(empty, F.lit(0.0)).otherwise(F.bround(part / whole, 3))

        return F.struct(
            F.when(empty, F.lit(0.0)).otherwise(F.bround(compound, 4) + 0.0).alias("compound"),
            portion(negative).alias("negative"),
            portion(neutral).alias("neutral"),
            portion(positive).alias("positive"),
        )

    return bind(
        F.struct(
            array_sum(scores).alias("total"),
            array_sum(F.transform(F.filter(scores, lambda v: v > 0), lambda v: v + 1)).alias("up"),
            array_sum(F.transform(F.filter(scores, lambda v: v < 0), lambda v: v - 1)).alias("down"),
            (token_total - F.size(F.filter(scores, lambda v: v != 0))).alias("neutral"),
        ),
        lambda sums: shares(sums["total"], sums["up"], sums["down"], sums["neutral"]),
    )


def _polarity(found: Column, lexicon: Lexicon) -> Column:
    """Scores of a text from the words its rules can reach and its numbers."""
    emphasis = _punctuation_emphasis(found["exclamations"], found["questions"])
    return bind(_hit_scores(found, lexicon), lambda scores: _combined(scores, found["token_total"], emphasis))


def polarity_scores(text: Column, lexicon: Lexicon) -> Column:
    """Struct of ``compound``, ``negative``, ``neutral`` and ``positive``."""
    return bind(found_words(text, lexicon), lambda found: _polarity(found, lexicon))


def _lexical_valence(token: Column, lower: Column, valence: Column, lexicon: Lexicon) -> Column:
    """Emoji first, then the word itself, then the word without edge punctuation."""
    core = F.btrim(lower, F.lit(PUNCTUATION))
    spare = F.when(core != lower, lexicon.valence_table()(core))
    return F.coalesce(
        F.when(token >= lexicon.first_emoji(), lexicon.emoji_table()(token)),
        valence,
        spare,
        F.lit(0.0),
    )


def token_valence(token: Column, lexicon: Lexicon) -> Column:
    """Lexical valence of a single token, no neighbours taken into account."""
    lower = F.lower(token)
    return _lexical_valence(token, lower, lexicon.valence_table()(lower), lexicon)


def _word_counts(found: Column) -> Column:
    # Counted are the tokens of the text as it is, emojis not spelled out.
    up, down, total = found["up"], found["down"], found["own_total"]
    return F.struct(
        up.alias("pos_word_count"),
        down.alias("neg_word_count"),
        (total - up - down).alias("neu_word_count"),
        total.alias("token_count"),
    )


def sentiment_word_counts(text: Column, lexicon: Lexicon) -> Column:
    """Struct of positive, negative, neutral and all tokens; the first three add up."""
    return bind(found_words(text, lexicon), _word_counts)


def sentiment_of(text: Column, lexicon: Lexicon) -> Column:
    """Scores and word counts together; a text is tokenised only once."""
    return bind(
        found_words(text, lexicon),
        lambda found: F.struct(_polarity(found, lexicon).alias("scores"), _word_counts(found).alias("counts")),
    )
