"""Quality classifier: a generalised additive model with pairwise interactions.

Fourteen features of a text are cut into bins. Learning goes round the features, again and
again; each visit fits a tree of at most three cuts to the gradients of the logistic loss over
the bins and adds a small part of it to the feature's lookup table. Then the pairs of
features that explain most of what is left get two-dimensional tables in the same way. A score is
the logistic of a sum of table entries, so scoring a batch is a handful of array additions.

The model is learned on the driver from at most ``sample`` labelled documents, those of the
smallest hashes (a bounded, documented sample: 20,000 rows of 14 numbers); everything else runs
where Spark put the documents. No shuffle of texts.

Defined results: null and empty texts have all features 0 and get the score of those bins; labels
that are null or whose document is missing are left out, the larger label counts where one id has
several; without labelled documents, or of one class only, every score is the smoothed share of
label 1; repeated rows get equal scores; an empty table gives an empty table. ``keep_good``
passes all input columns through whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrain.llm.common import Batches, id_remainder, small_batches, split_words, texts_of, trimmed

FEATURES = (
    "log_words", "word_length", "upper_share", "digit_share", "symbol_share", "mark_share", "exclamation_share",
    "distinct_words", "distinct_pairs", "most_frequent_word", "lines_per_word", "duplicate_lines",
    "other_bytes", "longest_word",
)
#: Labelled rows the model is learned from at most, and the fold that is held out.
SAMPLE = 20_000
FOLDS, HELD_OUT = 4, 2
#: A score from which a document counts as good.
THRESHOLD = 0.7

_BYTE_CLASS = np.full(256, 5)  # other bytes
for _class, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&|<>", b".,;:?'\"()-")):
    _BYTE_CLASS[list(_bytes)] = _class
_BYTE_CLASS[ord("!")] = 6
_BYTE_CLASS[list(b" \t\n\x0b\x0c\r")] = 7


def text_features(text: str) -> list[float]:
    """The features of one text; shares are of its bytes that are no white space, or of its words."""
    words = split_words(text)
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
    upper, lower, digits, symbols, marks, other, exclamations, _ = np.bincount(_BYTE_CLASS, weights=counts, minlength=8)
    solid = upper + lower + digits + symbols + marks + other + exclamations
    n = len(words)
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    return [
        float(np.log1p(n)),
        solid / n,
        upper / max(1.0, upper + lower),
        digits / solid,
        symbols / solid,
        marks / solid,
        exclamations / solid,
        len(set(words)) / n**0.8,
        len(set(zip(words, words[1:]))) / max(1, n - 1),
        max(Counter(words).values()) / n,
        len(lines) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        other / solid,
        float(np.log1p(max(map(len, words)))),
    ]


def feature_matrix(texts: list[str]) -> np.ndarray:
    return np.array([text_features(text) for text in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class AdditiveModel:
    """Bin borders of each feature, a table for each feature and for each chosen pair."""

    borders: list[np.ndarray]
    tables: list[np.ndarray]
    intercept: float
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, features: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(border, features[:, at], side="right") for at, border in enumerate(self.borders)]

    def logits(self, bins: list[np.ndarray], rows: int) -> np.ndarray:
        total = np.full(rows, self.intercept)
        for table, at in zip(self.tables, bins):
            total += table[at]
        for (a, b), table in self.pairs.items():
            total += table[bins[a], bins[b]]
        return total

    def scores(self, features: np.ndarray) -> np.ndarray:
        return logistic(self.logits(self.bins(features), len(features)))


def logistic(value: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(value, -30, 30)))


def _gain(gradient: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    return gradient**2 / (weight + ridge)


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, cuts: int, ridge: float) -> np.ndarray:
    """Values of a tree of at most ``cuts`` cuts over ordered bins, given sums per bin."""
    parts = [(0, len(gradient))]
    for _ in range(cuts):
        best = (1e-9, None, None)
        for start, end in parts:
            if end - start < 2:
                continue
            g, w = np.cumsum(gradient[start:end]), np.cumsum(weight[start:end])
            gains = _gain(g[:-1], w[:-1], ridge) + _gain(g[-1] - g[:-1], w[-1] - w[:-1], ridge) - _gain(g[-1], w[-1], ridge)
            at = int(np.argmax(gains))
            if gains[at] > best[0]:
                best = (gains[at], (start, end), start + at + 1)
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    values = np.zeros(len(gradient))
    for start, end in parts:
        values[start:end] = gradient[start:end].sum() / (weight[start:end].sum() + ridge)
    return values


def pair_tree(gradient: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cut of the one feature with a cut of the other on either side; its gain and values."""
    best_gain, best = -1.0, np.zeros_like(gradient)
    for turned in (False, True):
        g, w = (gradient.T, weight.T) if turned else (gradient, weight)
        above_g, above_w = np.cumsum(g, axis=0), np.cumsum(w, axis=0)
        sides = []
        for side_g, side_w in ((above_g[:-1], above_w[:-1]), (above_g[-1] - above_g[:-1], above_w[-1] - above_w[:-1])):
            left_g, left_w = np.cumsum(side_g, axis=1), np.cumsum(side_w, axis=1)
            gains = _gain(left_g[:, :-1], left_w[:, :-1], ridge) + _gain(
                left_g[:, -1:] - left_g[:, :-1], left_w[:, -1:] - left_w[:, :-1], ridge
            )
            sides.append((gains.max(axis=1), gains.argmax(axis=1)))
        total = sides[0][0] + sides[1][0]
        cut = int(np.argmax(total))
        if total[cut] > best_gain:
            values = np.zeros(g.shape)
            for rows, (_, columns) in ((slice(0, cut + 1), sides[0]), (slice(cut + 1, None), sides[1])):
                for part in (slice(0, columns[cut] + 1), slice(columns[cut] + 1, None)):
                    values[rows, part] = g[rows, part].sum() / (w[rows, part].sum() + ridge)
            best_gain, best = float(total[cut]), values.T if turned else values
    return best_gain, best


def fit(
    features: np.ndarray,
    labels: np.ndarray,
    bins: int = 32,
    rounds: int = 150,
    pair_rounds: int = 60,
    n_pairs: int = 6,
    rate: float = 0.15,
    cuts: int = 3,
    ridge: float = 2.0,
) -> AdditiveModel:
    """Cyclic boosting, first of single features, then of the pairs with the largest gains."""
    n = len(labels)
    prior = (labels.sum() + 1.0) / (n + 2.0)
    shares = np.linspace(0, 1, bins + 1)[1:-1]
    borders = [np.unique(np.quantile(column, shares)) if n else np.zeros(0) for column in features.T]
    model = AdditiveModel(borders, [np.zeros(len(border) + 1) for border in borders], float(np.log(prior / (1 - prior))))
    if n == 0 or labels.min() == labels.max():
        return model
    at = model.bins(features)
    logit = model.logits(at, n)

    def sums(index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        score = logistic(logit)
        return (
            np.bincount(index, weights=labels - score, minlength=size),
            np.bincount(index, weights=score * (1 - score), minlength=size),
        )

    for _ in range(rounds):
        for feature, table in enumerate(model.tables):
            if len(table) < 2:
                continue
            step = rate * shallow_tree(*sums(at[feature], len(table)), cuts, ridge)
            table += step
            logit += step[at[feature]]
    sizes = [len(table) for table in model.tables]
    flat = {
        (a, b): at[a] * sizes[b] + at[b]
        for a in range(len(sizes))
        for b in range(a + 1, len(sizes))
        if sizes[a] > 1 and sizes[b] > 1
    }

    def pair_step(pair: tuple[int, int]) -> tuple[float, np.ndarray]:
        shape = (sizes[pair[0]], sizes[pair[1]])
        gradient, weight = sums(flat[pair], shape[0] * shape[1])
        return pair_tree(gradient.reshape(shape), weight.reshape(shape), ridge)

    gains = sorted(((-pair_step(pair)[0], pair) for pair in flat))
    for _, pair in gains[:n_pairs]:
        model.pairs[pair] = np.zeros((sizes[pair[0]], sizes[pair[1]]))
    for _ in range(pair_rounds):
        for pair, table in model.pairs.items():
            step = rate * pair_step(pair)[1]
            table += step
            logit += step.ravel()[flat[pair]]
    return model


def learn(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> AdditiveModel:
    """Fit on the labelled documents of the smallest id hashes outside the held-out fold."""
    usable = labels.where(F.col(label).isNotNull() & (id_remainder("doc_id", FOLDS) != HELD_OUT))
    chosen = (
        usable.groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    def run(batches: Batches) -> Batches:
        for batch in small_batches(batches):
            rows = feature_matrix(texts_of(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows.tolist(), pa.list_(pa.float64()))], ["doc_id", "label", "f"]
            )

    # At most ``sample`` ids: small enough to send to every task.
    joined = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    rows = joined.mapInArrow(trimmed(run), "doc_id long, label double, f array<double>").groupBy("doc_id", "label").agg(F.min("f").alias("f"))
    found = sorted((row.doc_id, row.label, list(row.f)) for row in rows.collect())
    features = np.array([row[2] for row in found]).reshape(len(found), len(FEATURES))
    return fit(features, np.array([row[1] for row in found]))


def score(documents: DataFrame, model: AdditiveModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text."""

    def run(batches: Batches) -> Batches:
        for batch in small_batches(batches):
            values = model.scores(feature_matrix(texts_of(batch)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "score"])

    scored = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(run), "doc_id long, score double")
    held_out = F.coalesce(id_remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` whose score reaches the threshold."""

    def run(batches: Batches) -> Batches:
        for batch in small_batches(batches):
            good = model.scores(feature_matrix(texts_of(batch))) >= threshold
            yield batch.filter(pa.array(good))

    return documents.mapInArrow(trimmed(run), documents.schema)
