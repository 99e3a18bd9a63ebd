"""Bigram language model in sharded Elias-Fano tries: learning, storing, scoring.

P(w | v) = (c(v, w) - D)+ / c(v) + l(v) P(w), where P(w) is the add-one unigram model and l(v)
what the discounts leave. Bigrams that occur at least ``min_count`` times are kept, all of them with
``EVERY``, as in query op10; the mass of the others goes to l(v), so the probabilities sum to one
either way. The logarithm of a text splits into
log P(w) + log l(v) for every token and, where (v, w) is kept, a gain
log(1 + (c(v, w) - D)+ / (c(v) l(v) P(w))). So all that concerns a word, the gains by context
included, lives in the word's shard, and a text's score is a sum over shards.

* Learning deals out counted bigrams by context (counts, discounts, l(v)), then the kept ones by
  word, and builds one trie per shard.
* Scoring deals out each large batch of texts by word as packed arrays, searches the shard's trie,
  and adds up per batch.
* Frequent words (at most 4 for each shard) are found first. As contexts they are spread over
  shards by the word that follows, as words by their context, so no shard grows with a hot word.
  Nothing but totals and these words reaches the driver.

Defined results: null and empty texts have one token, the end; documents whose id is null count as
training text; repeated rows are counted and scored each; with an empty training set every
token has probability 1 / (0 + 1 * (0 + 1)) = 1; an empty table gives an empty table. Contexts and
words of bigrams are 32-bit fingerprints, counts of words go by 64 bits.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrain.llm.common import Batches, id_remainder, lower_words, small_batches, store, texts_of
from lexigrain.llm.elias_fano import NgramTrie

DISCOUNT = 0.75
#: How often a bigram must occur to be kept: each that occurs, and where nothing is asked for.
EVERY = MIN_COUNT = 1
FOLDS, HELD_OUT = 7, 2
#: Tokens a task gathers before it counts and deals them.
BATCH_TOKENS = 1_600_000
START, END = np.uint64(1), np.uint64(2)
#: The back-off mass is at least so much, whatever rounding leaves.
LEAST_LEFT = 1e-9
_UPPER = np.uint64(32)
U32 = np.uint64(0xFFFFFFFF)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed buffer."""
    head = np.array([part for array in arrays for part in (len(array), array.itemsize)], dtype=np.int64)
    return zstandard.compress(b"".join([head.tobytes(), *(np.ascontiguousarray(array).tobytes() for array in arrays)]), 1)


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    head = np.frombuffer(raw, np.int64, 2 * len(kinds))
    arrays, at = [], head.nbytes
    for kind, (length, size) in zip(kinds, head.reshape(-1, 2).tolist()):
        arrays.append(np.frombuffer(raw, kind, length, at))
        at += length * size
    return arrays


class LocalIds(dict):
    """Words of one batch, numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value

    def hashes(self) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(word) for word in self), dtype=np.uint64, count=len(self))


@dataclass
class TokenBatch:
    """Tokens of many documents as places in ``hashes``; place 0 is the start, 1 the end."""

    contexts: np.ndarray
    words: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray
    doc_ids: pa.Array


def token_batches(batches: Batches) -> chain:
    """Large batches of tokens: words of each text, then one end; ``doc_id, text`` come in."""
    ids, parts, lengths, docs, size = LocalIds(), [], [], [], 0

    def gathered() -> TokenBatch:
        n = np.array(lengths, dtype=np.int64)
        ends = np.cumsum(n)
        flat = np.concatenate([*parts, np.zeros(0, np.int64)])
        words, contexts = np.empty(len(flat) + len(n), np.int64), np.empty(len(flat) + len(n), np.int64)
        plain = np.ones(len(words), bool)
        plain[ends + np.arange(len(n))] = False
        words[plain], words[~plain] = flat + 2, 1
        plain[:] = True
        plain[ends - n + np.arange(len(n))] = False
        contexts[plain], contexts[~plain] = flat + 2, 0
        hashes = np.concatenate([[START, END], ids.hashes()]).astype(np.uint64)
        return TokenBatch(contexts, words, n + 1, hashes, pa.concat_arrays(docs))

    for batch in small_batches(batches):
        split = [lower_words(text) for text in texts_of(batch)]
        counts = [len(words) for words in split]
        parts.append(np.fromiter(map(ids.__getitem__, chain.from_iterable(split)), np.int64, sum(counts)))
        lengths += counts
        docs.append(batch.column(0))
        size += len(parts[-1]) + len(counts)
        if size >= BATCH_TOKENS:
            yield gathered()
            ids, parts, lengths, docs, size = LocalIds(), [], [], [], 0
    if lengths:
        yield gathered()


def runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Hot:
    """The very frequent words (and the start), sorted, and over how many shards each is spread."""

    words: np.ndarray
    spread: np.ndarray

    @staticmethod
    def looked_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """The value of each asked key, 1 for others; ``keys`` are sorted."""
        found = np.ones(len(asked), np.int64)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            same = keys[at] == asked
            found[same] = values[at[same]]
        return found

    def spread_of(self, words: np.ndarray) -> np.ndarray:
        return self.looked_up(self.words, self.spread, words)

    def holds(self, words: np.ndarray) -> np.ndarray:
        return np.isin(words, self.words)


@dataclass(frozen=True)
class Totals:
    """What every task knows of the corpus."""

    tokens: int
    distinct: int
    start_backoff: float
    shards: int
    hot: Hot

    def unigram_logs(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.tokens + 1.0 * (self.distinct + 1)))

    def spread_of(self, uppers: np.ndarray) -> np.ndarray:
        return self.hot.looked_up(self.hot.words >> _UPPER, self.hot.spread, uppers)

    def shards_of(self, uppers: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """The shard of a word (upper half) in a context (upper half)."""
        spread = self.spread_of(uppers).astype(np.uint64)
        return ((uppers + contexts % spread) % np.uint64(self.shards)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    totals: Totals
    shards: DataFrame  # shard int, trie binary


def frequent_words(training: DataFrame, shards: int) -> Hot:
    """Words of at least about 1 / (2 * shards) of all tokens.

    Every batch reports the words that reach half of that share in it, so none is missed; at most
    4 * shards words come back.
    """

    def run(batches: Batches) -> Batches:
        for batch in token_batches(batches):
            counts = np.bincount(batch.contexts, minlength=len(batch.hashes))
            often = np.flatnonzero(counts * 4 * shards >= len(batch.contexts))
            words = pa.concat_arrays([pa.array(batch.hashes[often].view(np.int64)), pa.nulls(1, pa.int64())])
            yield pa.RecordBatch.from_arrays([words, pa.array([*counts[often].tolist(), len(batch.contexts)])], ["word", "n"])

    seen = training.select("doc_id", "text").mapInArrow(run, "word long, n long")
    sums = store(seen.groupBy("word").agg(F.sum("n").alias("n")), "ngram-frequent")
    total = sums.where("word is null").agg(F.sum("n")).first()[0] or 0
    rows = sums.where(F.col("word").isNotNull() & (F.col("n") * 4 * shards >= total)).collect()
    spread = {row.word & 0xFFFFFFFFFFFFFFFF: max(1, min(shards, -(-2 * shards * row.n // total))) for row in rows}
    # The start is a context in every document, so it always goes with the frequent ones.
    found = sorted((spread | {int(START): spread.get(int(START), 1)}).items())
    return Hot(np.array([word for word, _ in found], dtype=np.uint64), np.array([spread for _, spread in found], dtype=np.int64))


def counted(training: DataFrame, shards: int, hot: Hot) -> DataFrame:
    """Per batch and shard of contexts the counted bigrams: ``shard, data``.

    A very frequent context is spread over shards by the word that follows.
    """

    def run(batches: Batches) -> Batches:
        for batch in token_batches(batches):
            keys = np.sort(batch.contexts << 32 | batch.words)
            first = runs(keys)
            count = np.diff([*first, len(keys)]).astype(np.uint32)
            context, word = keys[first] >> 32, keys[first] & 0xFFFFFFFF
            uppers = batch.hashes >> _UPPER
            shard = (uppers[context] % np.uint64(shards)).astype(np.int64)
            spread = hot.spread_of(batch.hashes)
            wide = np.flatnonzero(spread[context] > 1)
            step = uppers[word[wide]] % spread[context[wide]].astype(np.uint64)
            shard[wide] = ((uppers[context[wide]] + step) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard << 32 | context, kind="stable")
            shard, context, count = shard[order], context[order], count[order]
            upper = uppers[word[order]].astype(np.uint32)
            cuts = runs(shard)
            for start, end in zip(cuts, [*cuts[1:], len(context)]):
                heads = runs(context[start:end])
                sizes = np.diff([*heads, end - start]).astype(np.uint32)
                data = pack(batch.hashes[context[start:end][heads]], sizes, upper[start:end], count[start:end])
                yield pa.RecordBatch.from_arrays([pa.array([shard[start]], pa.int32()), pa.array([data])], ["shard", "data"])

    return training.select("doc_id", "text").mapInArrow(run, "shard int, data binary")


STATISTICS = "tokens long, distinct long, words binary, hot binary, raw boolean, bigrams binary"


def context_statistics(counts: DataFrame, parts: int, hot: Hot, min_count: int = MIN_COUNT) -> DataFrame:
    """Kept bigrams and words of the contexts of each task.

    ``words`` packs the words' hashes, counts and log l; ``bigrams`` packs words, contexts (upper
    halves) and log10 of the discounted probability over l. Of frequent contexts a task sees a
    part only: ``hot`` packs the context, its count and its kept mass there, and the bigrams are
    ``raw``, log10 of the discounted counts. ``tokens, distinct`` are sums.
    """

    def row(tokens=0, distinct=0, words=None, partial=None, raw=None, bigrams=None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([tokens], pa.int64()), pa.array([distinct], pa.int64()), pa.array([words], pa.binary()),
                pa.array([partial], pa.binary()), pa.array([raw], pa.bool_()), pa.array([bigrams], pa.binary()),
            ],
            ["tokens", "distinct", "words", "hot", "raw", "bigrams"],
        )

    def run(batches: Batches) -> Batches:
        hashes, sizes, uppers, counts = [], [], [], []
        for batch in batches:
            for data in batch.column(1).to_pylist():
                for held, array in zip((hashes, sizes, uppers, counts), unpack(data, "u8", "u4", "u4", "u4")):
                    held.append(array)
        if not hashes:
            return
        contexts, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        keys = np.repeat(inverse, np.concatenate(sizes)).astype(np.uint64) << _UPPER | np.concatenate(uppers)
        order = np.argsort(keys)
        keys, each = keys[order], np.concatenate(counts)[order].astype(np.int64)
        first = runs(keys)
        each, keys = np.add.reduceat(each, first), keys[first]
        place = (keys >> _UPPER).astype(np.int64)
        total = np.bincount(place, weights=each, minlength=len(contexts)).astype(np.int64)
        kept = each >= min_count
        place, each, upper = place[kept], each[kept] - DISCOUNT, (keys[kept] & U32).astype(np.uint32)
        mass = np.bincount(place, weights=each, minlength=len(contexts))
        frequent = hot.holds(contexts)
        left = np.maximum(1.0 - mass / total, LEAST_LEFT)
        gain = np.log10(np.where(frequent[place], each, each / (total[place] * left[place]))).astype(np.float32)
        backoff = np.log10(left).astype(np.float32)
        own = ~frequent
        yield row(int(total.sum()), int(own.sum()), pack(contexts[own], total[own], backoff[own]),
                  pack(contexts[frequent], total[frequent], mass[frequent]))
        context = (contexts[place] >> _UPPER).astype(np.uint32)
        for raw in (False, True):
            chosen = np.flatnonzero(frequent[place] == raw)
            for at in range(0, len(chosen), 500_000):
                part = chosen[at : at + 500_000]
                yield row(raw=raw, bigrams=pack(upper[part], context[part], gain[part]))

    return counts.repartition(parts, "shard").mapInArrow(run, STATISTICS)


def built_shards(statistics: DataFrame, totals: Totals, scale: np.ndarray) -> DataFrame:
    """``shard, trie``: the trie of each shard of words.

    ``statistics`` has ``words, raw, bigrams``; ``scale`` is log10 of count times l of the frequent words.
    """

    def deal(batches: Batches) -> Batches:
        for batch in batches:
            words_in, raw_in, bigrams_in = (batch.column(at).to_pylist() for at in range(3))
            packed_in = [(data, True, False) for data in words_in] + [(data, False, raw) for data, raw in zip(bigrams_in, raw_in)]
            for data, is_word, raw in packed_in:
                if data is None:
                    continue
                if is_word:
                    words, counts, backoff = unpack(data, "u8", "i8", "f4")
                    spread = totals.spread_of(words >> _UPPER)
                    row = np.repeat(np.arange(len(words)), spread)
                    step = np.arange(len(row)) - np.repeat(np.cumsum(spread) - spread, spread)
                    shard = (((words[row] >> _UPPER) + step.astype(np.uint64)) % np.uint64(totals.shards)).astype(np.int64)
                    columns = [words[row], counts[row], backoff[row]]
                else:
                    upper, contexts, gain = unpack(data, "u4", "u4", "f4")
                    if raw:
                        gain = gain - scale[np.searchsorted(totals.hot.words >> _UPPER, contexts)].astype(np.float32)
                    shard = totals.shards_of(upper.astype(np.uint64), contexts.astype(np.uint64))
                    columns = [upper, contexts, gain]
                order = np.argsort(shard, kind="stable")
                cuts = runs(shard[order])
                for start, end in zip(cuts, [*cuts[1:], len(order)]):
                    chosen = order[start:end]
                    packed = pack(*(column[chosen] for column in columns))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard[chosen[0]]], pa.int32()), pa.array([is_word]), pa.array([packed])],
                        ["shard", "is_word", "data"],
                    )

    def build(table: pa.Table) -> pa.Table:
        words, bigrams = [], []
        for is_word, data in zip(table.column("is_word").to_pylist(), table.column("data").to_pylist()):
            (words if is_word else bigrams).append(unpack(data, *(("u8", "i8", "f4") if is_word else ("u4", "u4", "f4"))))
        ids, counts, backoff = (np.concatenate(parts) for parts in zip(*words)) if words else (np.zeros(0, "u8"), np.zeros(0, "i8"), np.zeros(0, "f4"))
        order = np.argsort(ids)
        ids, counts, backoff = ids[order], counts[order], backoff[order]
        upper, contexts, gain = (np.concatenate(parts) for parts in zip(*bigrams)) if bigrams else (np.zeros(0, "u4"), np.zeros(0, "u4"), np.zeros(0, "f4"))
        uppers = ids >> _UPPER
        place = np.minimum(np.searchsorted(uppers, upper), max(0, len(ids) - 1))
        chance = totals.unigram_logs(counts[place]) if len(ids) else np.zeros(len(upper))
        gains = np.log10(1.0 + 10.0 ** (gain.astype(np.float64) - chance))
        trie = NgramTrie.build(ids, counts, backoff.astype(np.float64), upper.astype(np.uint64), contexts, gains)
        return pa.table({"shard": table.column("shard").slice(0, 1), "trie": pa.array([trie.buffer()], pa.binary())})

    dealt = statistics.mapInArrow(deal, "shard int, is_word boolean, data binary")
    return dealt.groupBy("shard").applyInArrow(build, "shard int, trie binary")


def learn(training: DataFrame, min_count: int = MIN_COUNT) -> LanguageModel:
    """Learn from ``doc_id, text`` and store the shards in the shared folder."""
    spark = training.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = frequent_words(training, parts)
    statistics = store(context_statistics(counted(training, 4 * parts, hot), parts, hot, min_count), "ngram-statistics")
    sums = statistics.agg(F.sum("tokens"), F.sum("distinct")).first()
    # Of each frequent word a line per shard it is spread over: a few for each shard in all.
    counts, mass = np.zeros(len(hot.words), np.int64), np.zeros(len(hot.words))
    for row in statistics.where("hot is not null").select("hot").collect():
        words, count, kept = unpack(bytes(row.hot), "u8", "i8", "f8")
        at = np.searchsorted(hot.words, words)
        np.add.at(counts, at, count)
        np.add.at(mass, at, kept)
    found = counts > 0
    left = np.maximum(1.0 - mass / np.maximum(counts, 1), LEAST_LEFT)
    logs = np.where(found, np.log10(left), 0.0)
    starts = hot.words == START
    totals = Totals(sums[0] or 0, (sums[1] or 0) + int(found.sum()), float(logs[starts].sum()), parts, hot)
    # The start is a context but no word; the end is a word as often, and no context.
    words, backoff = np.where(starts, END, hot.words), np.where(starts, 0.0, logs).astype(np.float32)
    frequent = spark.createDataFrame(
        [(pack(words[found], counts[found], backoff[found]), None, None)], "words binary, raw boolean, bigrams binary"
    )
    rows = statistics.select("words", "raw", "bigrams").union(frequent)
    scale = np.log10(np.maximum(counts, 1)) + logs
    return LanguageModel(totals, store(built_shards(rows, totals, scale), "ngram-tries"))


def dealt_tokens(documents: DataFrame, totals: Totals) -> DataFrame:
    """Per batch and shard the tokens of the documents: ``shard, batch, docs, data, home``.

    ``home`` holds the documents' ids and token counts; it stands in one row of each batch.
    """

    def run(batches: Batches) -> Batches:
        for number, batch in enumerate(token_batches(batches)):
            uppers = batch.hashes >> _UPPER
            spread = totals.spread_of(uppers)
            shard = (uppers[batch.words] % np.uint64(totals.shards)).astype(np.int64)
            wide = spread[batch.words] > 1
            shard[wide] = totals.shards_of(uppers[batch.words[wide]], uppers[batch.contexts[wide]])
            doc = np.repeat(np.arange(len(batch.lengths), dtype=np.uint32), batch.lengths)
            order = np.argsort(shard << 32 | batch.words, kind="stable")
            shard = shard[order]
            cuts = runs(shard)
            name = TaskContext.get().partitionId() << 24 | number
            valid = np.asarray(batch.doc_ids.is_valid())
            home = pack(np.asarray(batch.doc_ids.fill_null(0)), valid, batch.lengths)
            for start, end in zip(cuts, [*cuts[1:], len(order)]):
                chosen = order[start:end]
                words = batch.words[chosen]
                heads = runs(words)
                data = pack(
                    batch.hashes[words[heads]],
                    np.diff([*heads, len(words)]).astype(np.uint32),
                    uppers[batch.contexts[chosen]].astype(np.uint32),
                    doc[chosen],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard[start]], pa.int32()), pa.array([name]), pa.array([len(batch.lengths)]),
                        pa.array([data]), pa.array([home if start == 0 else None], pa.binary()),
                    ],
                    ["shard", "batch", "docs", "data", "home"],
                )

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "shard int, batch long, docs long, data binary, home binary")


def sums_by_shard(dealt: DataFrame, model: LanguageModel) -> DataFrame:
    """Per batch and shard what the shard adds to each of its documents: ``batch, docs, sums, home``."""
    totals = model.totals

    def search(key: tuple, tokens: pa.Table, tries: pa.Table) -> pa.Table:
        trie = NgramTrie.open(tries.column("trie")[0].as_buffer()) if tries.num_rows else None
        sums = []
        for data in tokens.column("data").to_pylist():
            words, sizes, contexts, doc = unpack(data, "u8", "u4", "u4", "u4")
            at, counts, backoff = trie.look_up(words) if trie else (np.full(len(words), -1), np.zeros(len(words)), np.zeros(len(words)))
            base = np.repeat(totals.unigram_logs(counts), sizes)
            more = np.repeat(backoff, sizes)
            if trie:
                more = more + trie.gains_of(np.repeat(at, sizes), contexts.astype(np.uint64))
            known = np.repeat(counts > 0, sizes)
            present, place = np.unique(doc, return_inverse=True)
            sums.append(pack(
                present, np.bincount(place, weights=base), np.bincount(place, weights=more).astype(np.float32),
                np.bincount(place, weights=known).astype(np.uint32),
            ))
        return pa.table({
            "batch": tokens.column("batch"), "docs": tokens.column("docs"),
            "sums": pa.array(sums, pa.binary()), "home": tokens.column("home"),
        })

    grouped = dealt.groupBy("shard").cogroup(model.shards.groupBy("shard"))
    return grouped.applyInArrow(search, "batch long, docs long, sums binary, home binary")


def score(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of every text (logarithms to base 10)."""
    start = model.totals.start_backoff

    def add_up(table: pa.Table) -> pa.Table:
        docs = table.column("docs")[0].as_py()
        base, more, known = np.zeros(docs), np.full(docs, start), np.zeros(docs, np.int64)
        home = next(part for part in table.column("home").to_pylist() if part is not None)
        ids, valid, lengths = unpack(home, "i8", "?", "i8")
        packed = sorted(table.column("sums").to_pylist(), key=zlib.crc32)  # one order of summation for every run
        for data in packed:
            present, b, m, k = unpack(data, "u4", "f8", "f4", "u4")
            base[present] += b
            more[present] += m
            known[present] += k
        return pa.table({
            "doc_id": pa.array(ids, mask=~valid), "n_tokens": pa.array(lengths), "n_known": pa.array(known),
            "base_score": pa.array(base), "score": pa.array(base + more),
        })

    sums = sums_by_shard(dealt_tokens(documents, model.totals), model)
    return sums.groupBy("batch").applyInArrow(
        add_up, "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )


def held_out_scores(documents: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Learn from all documents but a fold and score all of them."""
    held_out = F.coalesce(id_remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    model = learn(documents.where(~held_out), min_count)
    return score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.totals.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
