"""Exact stratified split, reproducible by id and seed."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrain.fixed_values import LABELS, SEED, TEST_SHARE
from lexigrain.session import materialise

TRAIN, TEST = "train", "test"
#: Leading hex digits of the row hash that form a bucket (1,048,576 buckets).
BUCKET_DIGITS = 5
#: Equal rows that are written out together.
COPIES = 4096


def row_hash(key: str = "id", seed: int = SEED) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def test_quotas(sizes: Mapping[int, int], share: float = TEST_SHARE) -> dict[int, int]:
    """Test rows per label: the rounded-up total, shared out by largest remainder."""
    total = sum(sizes.values())
    # Rounding guards against a product such as 0.2 * 35 landing just above an integer.
    wanted = math.ceil(round(share * total, 9))
    ideal = {label: wanted * n / total for label, n in sizes.items()} if total else dict(sizes)
    quotas = {label: math.floor(value) for label, value in ideal.items()}
    by_remainder = sorted(ideal, key=lambda label: (quotas[label] - ideal[label], label))
    for label in by_remainder[: wanted - sum(quotas.values())]:
        quotas[label] += 1
    return quotas


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def bucket_counts(hashed: DataFrame) -> DataFrame:
    """``target, _bucket, size`` of ``target, _hash`` rows, stored: at most 16^BUCKET_DIGITS rows per label."""
    bucket = F.substring("_hash", 1, BUCKET_DIGITS).alias("_bucket")
    return materialise(hashed.groupBy("target", bucket).agg(F.count(F.lit(1)).alias("size")))


def hash_cuts(hashed: DataFrame, counts: DataFrame, ranks: Mapping[int, Sequence[int]]) -> list[Row]:
    """For each label and rank (from 1) the hash that holds it: ``target, rank, hash, before, ties``.

    Prefix sums over the buckets find the bucket of a rank, prefix sums over that bucket's distinct hashes
    the hash. ``before`` rows of the label have smaller hashes, ``ties`` rows that very one: rows are never
    sorted, and equal ids, however many, are one line. One row per label and rank comes back.
    """
    wanted = F.array().cast("array<long>")
    for label, places in ranks.items():
        some = F.array(*[F.lit(place).cast("long") for place in places])
        wanted = F.when(F.col("target") == label, some).otherwise(wanted)

    def with_ranks(frame: DataFrame, order: str, groups: Sequence[str], before: Column) -> DataFrame:
        running = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        reached = frame.withColumn("_reached", before + F.sum("size").over(running))
        here = F.filter("_wanted", lambda rank: (rank > F.col("_reached") - F.col("size")) & (rank <= F.col("_reached")))
        return reached.withColumn("_here", here).where(F.size("_here") > 0)

    found = with_ranks(counts.withColumn("_wanted", wanted), "_bucket", ["target"], F.lit(0))
    buckets = found.select("target", "_bucket", (F.col("_reached") - F.col("size")).alias("_before")).collect()
    inside, before = [], F.lit(0)
    for row in buckets:
        here = (F.col("target") == row.target) & (F.substring("_hash", 1, BUCKET_DIGITS) == row._bucket)
        inside.append(here)
        before = F.when(here, F.lit(row._before)).otherwise(before)
    distinct = (
        hashed.where(_any(inside)).groupBy("target", "_hash").agg(F.count(F.lit(1)).alias("size"))
        .withColumns({"_wanted": wanted, "_before": before, "_bucket": F.substring("_hash", 1, BUCKET_DIGITS)})
    )
    placed = with_ranks(distinct, "_hash", ["target", "_bucket"], F.col("_before"))
    return placed.select(
        "target",
        F.explode("_here").alias("rank"),
        F.col("_hash").alias("hash"),
        (F.col("_reached") - F.col("size")).alias("before"),
        F.col("size").alias("ties"),
    ).collect()


def _label_sizes(counts: DataFrame, labels: Sequence[int]) -> dict[int, int]:
    sizes = {row.target: row.n for row in counts.groupBy("target").agg(F.sum("size").alias("n")).collect()}
    return {label: sizes.get(label, 0) for label in labels}


def _equal_rows(same: DataFrame, wanted: Mapping[int, int]) -> DataFrame:
    """``same`` with ``split``: of each label's rows, equal in all columns, so many are test rows."""
    columns = same.columns
    quota = F.lit(0)
    for label, n in wanted.items():
        quota = F.when(F.col("target") == label, F.lit(n)).otherwise(quota)
    groups = same.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("target").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))  # one group, but for colliding hashes
    tested = F.least(F.greatest(quota - before, F.lit(0)), F.col("_n"))
    sides = F.array(
        F.struct(F.lit(TEST).alias("split"), F.col("_tested").alias("n")),
        F.struct(F.lit(TRAIN).alias("split"), (F.col("_n") - F.col("_tested")).alias("n")),
    )
    halves = groups.withColumn("_tested", tested).select(*columns, F.inline(F.filter(sides, lambda side: side["n"] > 0)))
    steps = halves.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n", F.lit(COPIES).cast("long"))).alias("_first"))
    last = F.least(F.col("n"), F.col("_first") + COPIES - 1)
    return steps.select(*columns, "split", F.explode(F.sequence("_first", last)).alias("_copy")).drop("_copy")


def stratified_split(
    corpus: DataFrame,
    share: float = TEST_SHARE,
    seed: int = SEED,
    labels: Sequence[int] = LABELS,
    key: str = "id",
) -> DataFrame:
    """Add ``split``: exactly ``ceil(share * n)`` test rows with the class shares kept.

    The rows of a class with the smallest hashes form its test part, so only the hash
    of the last test row is needed per class; the corpus is then split by comparing hashes,
    without a sort or a shuffle. Where several rows share that last hash, as rows of one id do, a hash
    of the whole row decides between them in the same way, and of rows that are equal in every
    column the right number is taken. So the quota is exact however often an id repeats.
    """
    labelled = corpus.where(F.col("target").isin(list(labels)))
    hashed = labelled.select("target", row_hash(key, seed).alias("_hash"))
    counts = bucket_counts(hashed)
    quotas = test_quotas(_label_sizes(counts, labels), share)
    cuts = hash_cuts(hashed, counts, {label: [n] for label, n in quotas.items() if n})

    hash_ = row_hash(key, seed)
    content = F.md5(F.xxhash64(*[f.name for f in labelled.schema.fields if not isinstance(f.dataType, T.MapType)]).cast("string"))
    in_test, inside, left = F.lit(False), [], {}
    for cut in cuts:
        of_label, need = F.col("target") == cut.target, cut.rank - cut.before
        in_test = in_test | (of_label & (hash_ < cut.hash))
        tie = of_label & (hash_ == cut.hash)
        if need == cut.ties:
            in_test = in_test | tie
            continue
        rows = labelled.where(tie).select("target", content.alias("_hash"))
        (second,) = hash_cuts(rows, bucket_counts(rows), {cut.target: [need]})
        in_test = in_test | (tie & (content < second.hash))
        if need - second.before == second.ties:
            in_test = in_test | (tie & (content == second.hash))
        else:
            inside.append(tie & (content == second.hash))
            left[cut.target] = need - second.before
    split = labelled.withColumn("split", F.when(in_test, F.lit(TEST)).otherwise(F.lit(TRAIN)))
    if not inside:
        return split
    rest = split.where(~F.coalesce(_any(inside), F.lit(False)))
    return rest.unionByName(_equal_rows(labelled.where(_any(inside)), left))


def stratified_folds(corpus: DataFrame, folds: int, seed: int = SEED, labels: Sequence[int] = LABELS, key: str = "id") -> DataFrame:
    """Add ``fold`` (from 0): every class is dealt to the folds in equal numbers, but for rows of one id, which stay together."""
    hash_ = row_hash(key, f"fold{seed}")
    hashed = corpus.select("target", hash_.alias("_hash"))
    counts = bucket_counts(hashed)
    sizes = _label_sizes(counts, labels)
    ranks = {label: [n * k // folds for k in range(1, folds) if n * k // folds] for label, n in sizes.items()}
    fold = F.lit(0)
    for cut in hash_cuts(hashed, counts, ranks):
        fold = fold + ((F.col("target") == cut.target) & (hash_ > cut.hash)).cast("int")
    return corpus.withColumn("fold", fold)


def split_summary(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("target").alias("positives"),
        (100 * F.avg(F.col("target").cast("double"))).alias("positive_pct"),
    )


def same_split(left: DataFrame, right: DataFrame, key: str = "id") -> bool:
    """Whether two experiments used the same validation rows."""
    a, b = (frame.where(F.col("split") == TEST).select(key) for frame in (left, right))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
