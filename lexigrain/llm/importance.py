"""Importance resampling towards a target distribution, over hashed word n-grams.

Every text is normalised (A-Z lower-cased, words joined by single spaces) and scanned once; the CRC
of everything up to each word is kept. The CRC of any run of words then follows from two of these
prefixes: appending bytes to a text is linear over GF(2), so shifting the earlier prefix by the run's
length and adding it to the later one cancels all that stands before the run. No n-gram is ever
cut out or hashed on its own.

A feature is a run of 1 to ``longest`` words, its bucket the CRC-32 of its bytes modulo ``buckets``. Raw
and target texts are counted per bucket (one row of counts per task), a bucket's gain is the scaled
logarithm of its smoothed share in the target over that in the raw texts, a document's weight the
floored mean of its features' gains. Adding a Gumbel number that depends on the id alone and taking
the highest scores draws without replacement in proportion to exp(weight / 1000). What reaches the driver is
one number per bucket. Ranks come from prefix sums over ranges of scores, never from one sorted task.

Defined results: null and empty texts, and texts without a word, have no feature and weight 0; a text of
any length is scanned in runs of bounded size; equal rows are separate documents that share a place
and get consecutive ranks; a null doc_id draws its Gumbel number from the empty string and goes
before other ids at ties; an empty table gives an empty result, an empty target equal gains for equal
counts. Further columns of the input, whatever their names, stay in ``resample`` and are ignored elsewhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrain.llm.common import Batches, small_batches, store
from lexigrain.operators.ranking import prefix_sums

LONGEST = 2
BUCKETS = 10_000
SHARE_PERCENT = 25
MIN_WORDS = 20
SEED = 7
#: Equal rows whose ranks are written out together.
COPIES = 4096
#: Bytes of text whose words are held at once.
RUN_BYTES = 1 << 18

#: Letters and digits stay (capitals as small letters), bytes of other characters too; the rest separates.
NORMAL = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if byte >= 0x80 or chr(byte).isalnum() else 0x20 for byte in range(256)
)
_POLYNOMIAL = 0xEDB88320
#: Shifts shorter than this come from one table each.
_SHORT = 64


@cache
def _byte_table() -> np.ndarray:
    """What each byte adds to a CRC register when it is shifted out."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


def _append_zero(crc: np.ndarray) -> np.ndarray:
    return (crc >> np.uint32(8)) ^ _byte_table()[crc & np.uint32(255)]


@cache
def _short_shifts() -> np.ndarray:
    """``[length, place, byte]``: a byte at a place of the register after ``length`` zero bytes."""
    tables = [np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]]
    for _ in range(_SHORT):
        tables.append(_append_zero(tables[-1]))
    return np.stack(tables)


@cache
def _doubled_shifts() -> list[np.ndarray]:
    """Tables for shifts by _SHORT, 2 * _SHORT, 4 * _SHORT … bytes."""
    tables = [_short_shifts()[_SHORT]]
    for _ in range(34):
        tables.append(_apply(tables[-1], tables[-1]))
    return tables


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    low = np.uint32(255)
    out = table[0][crc & low]
    for place in range(1, 4):
        out = out ^ table[place][(crc >> np.uint32(8 * place)) & low]
    return out


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs after appending so many zero bytes (the linear part of CRC-32)."""
    low, short = np.uint32(255), _short_shifts()
    rest = lengths % _SHORT
    out = short[rest, 0, crc & low]
    for place in range(1, 4):
        out ^= short[rest, place, (crc >> np.uint32(8 * place)) & low]
    longer = np.flatnonzero(lengths >= _SHORT)
    if len(longer):
        times = lengths[longer] // _SHORT
        part = out[longer]
        for bit, table in enumerate(_doubled_shifts()):
            chosen = (times >> bit) & 1 == 1
            if chosen.any():
                part[chosen] = _apply(table, part[chosen])
        out[longer] = part
    return out


@cache
def _space_undone() -> tuple[np.ndarray, np.ndarray]:
    """By the top byte of a CRC: the register's lowest byte before a space was appended, and what that byte had added."""
    table = _byte_table()
    index = np.empty(256, dtype=np.uint32)
    index[table >> np.uint32(24)] = np.arange(256, dtype=np.uint32)
    return index ^ np.uint32(0x20), table[index]


def without_space(crc: np.ndarray) -> np.ndarray:
    """CRCs of texts from those of the same texts with one space appended."""
    register = ~crc
    byte, added = _space_undone()
    top = register >> np.uint32(24)
    return ~(((register ^ added[top]) << np.uint32(8)) | byte[top])


def word_runs(text: bytes, longest: int, size: int = RUN_BYTES) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text in runs of about ``size`` bytes, and how many of them only lead in from the run before."""
    normal, at, lead = text.translate(NORMAL), 0, []
    while at < len(normal):
        end = normal.find(b" ", at + size)
        end = len(normal) if end < 0 else end
        words = lead + normal[at:end].split()
        if len(words) > len(lead):
            yield words, len(lead)
        lead = words[len(words) - min(longest - 1, len(words)) :]
        at = end


def run_crcs(runs: list[tuple[list[bytes], int]], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the run of each n-gram and its CRC-32, from one scan of all words."""
    words = [word + b" " for run, _ in runs for word in run]
    count = len(words)
    before = np.fromiter(
        accumulate(words, lambda crc, word: zlib.crc32(word, crc), initial=0), dtype=np.uint32, count=count + 1
    )
    after = without_space(before[1:])
    places = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=count))])
    sizes = np.array([len(run) for run, _ in runs])
    owner = np.repeat(np.arange(len(runs)), sizes)
    # A word counts as the last of an n-gram where it is not part of the lead.
    lead = np.repeat(np.cumsum(sizes) - sizes + np.array([lead for _, lead in runs]), sizes) > np.arange(count)
    for size in range(1, longest + 1):
        last = np.arange(size - 1, count)
        last = last[(owner[last] == owner[last - size + 1]) & ~lead[last]]
        first = last - size + 1
        lengths = places[last + 1] - places[first] - 1
        yield owner[last], after[last] ^ shifted(before[first], lengths)


def features(texts: Iterable[bytes | None], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (place of the text, bucket), one entry per feature; a block covers about RUN_BYTES."""

    def block() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        places = np.array(owners)
        for run, crc in run_crcs(runs, longest):
            yield places[run], crc % np.uint32(buckets)

    runs, owners, held = [], [], 0
    for place, text in enumerate(texts):
        for words, lead in word_runs(text or b"", longest):
            runs.append((words, lead))
            owners.append(place)
            held += sum(map(len, words))
            if held >= RUN_BYTES:
                yield from block()
                runs, owners, held = [], [], 0
    if runs:
        yield from block()


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket."""

    def run(batches: Batches) -> Batches:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in small_batches(batches, column="bytes"):
            for _, bucket in features(batch.column(0).to_pylist(), longest, buckets):
                counts += np.bincount(bucket, minlength=buckets)
        kept = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(counts[kept])], ["bucket", "n"])

    partial = texts.select(F.col(text).cast("binary").alias("bytes")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        out[row.bucket] = row.n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed shares."""
    buckets = len(raw)
    above = (target + 1.0) * float(raw.sum() + buckets)
    below = (raw + 1.0) * float(target.sum() + buckets)
    return np.floor(1000.0 * np.log(above / below)).astype(np.int64)


def with_weights(documents: DataFrame, gains: np.ndarray, longest: int = LONGEST, text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document."""
    buckets = len(gains)

    def run(batches: Batches) -> Batches:
        for batch in small_batches(batches, column="bytes"):
            size = batch.num_rows
            words, counts, sums = (np.zeros(size, dtype=np.int64) for _ in range(3))
            texts = batch.column(1).to_pylist()
            for at, (place, bucket) in enumerate(features(texts, longest, buckets)):
                each = np.bincount(place, minlength=size)
                counts += each
                if at % longest == 0:  # the blocks of single words
                    words += each
                # Sums of integers below 2^53 are exact in doubles.
                sums += np.bincount(place, weights=gains[bucket], minlength=size).astype(np.int64)
            weight = sums // np.maximum(counts, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (words, counts, weight))], ["doc_id", "n_words", "n_features", "weight"]
            )

    rows = documents.select(F.col("doc_id").cast("long"), F.col(text).cast("binary").alias("bytes"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Floored thousandths of a Gumbel number fixed by the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.ln(-F.ln((head + 0.5) / 4294967296.0)))


def ranked(weights: DataFrame, share_percent: int = SHARE_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of ``with_weights`` rows; rank is null where a document is not drawn."""
    scored = store(weights.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "importance-scores")
    names = ["doc_id", "n_features", "weight", "score"]
    # Equal rows, a hot id among them, are one row until their ranks are known.
    groups = scored.where(F.col("n_words") >= min_words).groupBy(*names).agg(F.count("*").alias("n"))
    falling = groups.withColumn("falling", -F.col("score"))
    summed = prefix_sums(falling, [], ["n"], value="falling", then=["doc_id", "n_features", "weight"])
    # The ranks of equal rows are written out in steps, so that no row holds them all.
    step = F.lit(COPIES).cast("long")
    steps = summed.select(
        *names, "n", "before_n", "total_n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)).alias("done")
    )
    first, last = F.col("before_n") + F.col("done") + 1, F.col("before_n") + F.least("n", F.col("done") + step)
    placed = steps.select(*names, "total_n", F.explode(F.sequence(first, last)).alias("rank"))
    drawn = placed.select(*names, F.when(F.expr(f"rank <= ({share_percent} * total_n) div 100"), F.col("rank")).alias("rank"))
    rest = scored.where(F.col("n_words") < min_words).select(*names, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)


def importance_table(
    documents: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    share_percent: int = SHARE_PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the texts of ``target``."""
    raw = bucket_counts(documents, longest=longest, buckets=buckets)
    gains = bucket_gains(raw, bucket_counts(target, longest=longest, buckets=buckets))
    return ranked(with_weights(documents, gains, longest), share_percent, min_words, seed)


def resample(documents: DataFrame, target: DataFrame, **settings: int) -> DataFrame:
    """The drawn documents with all their columns; ids that stand in several rows are drawn as one group each."""
    table = importance_table(documents, target, **settings)
    drawn = table.where(F.col("rank").isNotNull()).select("doc_id").distinct()
    return documents.alias("d").join(drawn.alias("drawn"), F.expr("d.doc_id <=> drawn.doc_id"), "left_semi")


_WORDS = r"regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+')"

#: The same table in DuckDB's SQL, which hashes each distinct feature byte by byte.
ORACLE = rf"""
WITH RECURSIVE steps(k, byte, value) AS (
  SELECT 0, b, b::BIGINT FROM range(256) r(b)
  UNION ALL
  SELECT k + 1, byte, CASE WHEN value & 1 = 1 THEN xor(value >> 1, {_POLYNOMIAL}::BIGINT) ELSE value >> 1 END FROM steps WHERE k < 8
), lookup AS (SELECT list(value ORDER BY byte) AS entries FROM steps WHERE k = 8),
docs AS (SELECT row_number() OVER () AS place, doc_id, {_WORDS} AS words FROM documents),
bench AS (SELECT row_number() OVER () AS place, {_WORDS} AS words FROM benchmark),
doc_features AS (
  SELECT place, unnest(words) AS feature FROM docs
  UNION ALL SELECT place, unnest(list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) FROM docs WHERE len(words) > 1
), bench_features AS (
  SELECT unnest(words) AS feature FROM bench
  UNION ALL SELECT unnest(list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) FROM bench WHERE len(words) > 1
), spelled AS (
  SELECT feature, hex(encode(feature)) AS digits
  FROM (SELECT feature FROM doc_features UNION SELECT feature FROM bench_features)
), hashed AS (
  SELECT feature, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(len(digits) // 2), lambda k: ('0x' || digits[2 * k + 1 : 2 * k + 2])::BIGINT)),
    lambda crc, byte: xor(crc >> 8, entries[(xor(crc, byte) & 255) + 1])
  ), 4294967295::BIGINT) % {BUCKETS} AS bucket
  FROM spelled, lookup
), raw AS (SELECT bucket, count(*) AS s FROM doc_features JOIN hashed USING (feature) GROUP BY bucket),
wanted AS (SELECT bucket, count(*) AS t FROM bench_features JOIN hashed USING (feature) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM raw)::DOUBLE AS all_s, (SELECT coalesce(sum(t), 0) FROM wanted)::DOUBLE AS all_t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s + {BUCKETS}) / ((s::DOUBLE + 1) * (all_t + {BUCKETS}))))::BIGINT AS gain
  FROM raw LEFT JOIN wanted USING (bucket), totals
), sums AS (
  SELECT place, count(*) AS n_features, sum(gain) AS total
  FROM doc_features JOIN hashed USING (feature) JOIN gains USING (bucket) GROUP BY place
), weighed AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
    coalesce(floor(total::DOUBLE / n_features), 0)::BIGINT AS weight,
    ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE AS h
  FROM docs LEFT JOIN sums USING (place)
), scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score, n_words >= {MIN_WORDS} AS eligible FROM weighed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS place,
    count(*) OVER (PARTITION BY eligible) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= {SHARE_PERCENT} * n // 100 THEN place END AS rank FROM placed
"""
