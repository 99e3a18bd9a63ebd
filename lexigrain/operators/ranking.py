"""Ordered statistics without a single-task sort.

Raw rows are first compressed to ``(keys, value) -> counts`` with map-side aggregation,
which also disarms hot values. Prefix sums over the distinct values then run per
key where a key has few of them, and over ranges of values else: cut points come from one sketch of the
stored counts, each row finds its range by comparing with them, and the rows move once, to their
range, where both the sums and the windows are computed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrain.functions.expressions import literal_array
from lexigrain.session import materialise

#: Distinct values that one range holds, about; keys with fewer need no ranges.
ROWS_PER_RANGE = 65_536
#: Finest cut of one key (2 to this power ranges).
MOST_BITS = 16


def long_values(frame: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """``keys…, metric, value`` with one row per non-null measurement."""
    doubles = [F.col(m).cast("double").alias(m) for m in metrics]
    long = frame.select(*keys, *doubles).unpivot(list(keys), list(metrics), "metric", "value")
    return long.where(F.col("value").isNotNull())


def value_counts(
    frame: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    counts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Distinct values per key with row counts, or with the given conditional counts."""
    wanted = counts or {"n": F.count(F.lit(1))}
    return frame.groupBy(*keys, value).agg(*[agg.alias(name) for name, agg in wanted.items()])


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)], F.lit(True))


def place_among(value: Column, cuts: Column, bits: int, equal: bool = False) -> Column:
    """How many of the sorted ``cuts`` (fewer than 2^bits) are smaller than ``value``, or ``equal`` to it, by binary search."""

    def passed(cut: Column) -> Column:
        return cut <= value if equal else cut < value

    steps = F.array(*[F.lit(1 << bit) for bit in range(bits - 1, -1, -1)])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: at + F.when((at + step <= F.size(cuts)) & passed(F.get(cuts, at + step - 1)), step).otherwise(0),
    )


def range_bits(rows: int) -> int:
    """Binary digits of the number of ranges for so many rows."""
    return min(MOST_BITS, max(0, -(-rows // ROWS_PER_RANGE) - 1).bit_length())


def _even(value: Column, bits: int) -> Column:
    """Aggregate: 2^bits - 1 values that cut the rows into about equal parts."""
    grid = [at / (1 << bits) for at in range(1, 1 << bits)]
    return F.percentile_approx(value, grid, max(10_000, 8 << bits))


def even_cuts(frame: DataFrame, value: Column, bits: int) -> list[float]:
    """Sorted values that cut all rows into 2^bits about equal parts; at most 2^MOST_BITS numbers."""
    return sorted(frame.agg(_even(value, bits)).first()[0] or [])


def with_ranges(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``counts``, which must be stored, with ``_range``: a number that grows with the value, by key.

    Ranges of one key hold about equally many rows. The table of cuts has one entry per
    ROWS_PER_RANGE rows at most, for all keys together, and is broadcast.
    """
    sizes = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    largest = sizes.agg(F.max("_rows")).first()[0] or 0
    bits = range_bits(largest)
    if not bits:
        return counts.withColumn("_range", F.lit(0))
    number = F.col(value).cast("double")
    if not keys:
        return counts.withColumn("_range", place_among(number, literal_array(even_cuts(counts, number, bits)), bits))
    # A key takes as many of the cuts as its own size asks for.
    own_bits = F.least(F.lit(bits), F.ceil(F.log2(F.col("_rows") / ROWS_PER_RANGE)).cast("int"))
    step = F.pow(F.lit(2.0), F.lit(bits) - own_bits).cast("int")
    cuts = F.transform(F.sequence(step, F.lit((1 << bits) - 1), step), lambda at: F.get("_grid", at - 1))
    of = [f"_of_{at}" for at in range(len(keys))]
    table = (
        counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), _even(number, bits).alias("_grid"))
        .where(F.col("_rows") > ROWS_PER_RANGE)
        .select(*[F.col(key).alias(name) for key, name in zip(keys, of)], cuts.alias("_cuts"))
    )
    met = counts.join(F.broadcast(materialise(table)), _same(keys, of), "left")
    at = F.when(F.col("_cuts").isNull(), 0).otherwise(place_among(number, F.col("_cuts"), bits))
    return met.withColumn("_range", at).drop("_cuts", *of)


def prefix_sums(
    counts: DataFrame,
    keys: Sequence[str],
    weights: Sequence[str],
    value: str = "value",
    small_domain: bool = False,
    neighbours: bool = False,
    then: Sequence[str] = (),
    stored: bool = False,
) -> DataFrame:
    """Add ``before_w`` (sum over smaller values) and ``total_w`` for every weight.

    ``value`` is a number; ``then`` orders rows of equal value. ``neighbours`` also adds
    ``lower_w``, the weight at the next smaller value.

    ``small_domain`` states that a key has few distinct values by construction (rounded
    scores, labels), so that one window per key is safe. Otherwise the counts are stored once (unless
    ``stored`` says that they are), the values are cut into ranges, each range sums itself, and the
    sums of whole ranges, one row each, are broadcast back.
    """
    if small_domain:
        ordered = Window.partitionBy(*keys).orderBy(value, *then)
        earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy(*keys)
        return counts.select(
            "*",
            *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"before_{w}") for w in weights],
            *[F.sum(w).over(whole).alias(f"total_{w}") for w in weights],
            *[F.lag(w).over(ordered).alias(f"lower_{w}") for w in weights if neighbours],
        )

    ranged = with_ranges(counts if stored else materialise(counts), keys, value)
    return prefix_over_ranges(ranged, keys, weights, value, neighbours, then)


def prefix_over_ranges(
    ranged: DataFrame,
    keys: Sequence[str],
    weights: Sequence[str],
    value: str,
    neighbours: bool = False,
    then: Sequence[str] = (),
) -> DataFrame:
    """Prefix sums of stored rows that know their ``_range``; the rows move once, to their range."""
    # At most one row per key and range, whatever the data size.
    sums = ranged.groupBy(*keys, "_range").agg(
        *[F.sum(w).alias(f"_sum_{w}") for w in weights],
        *[F.max_by(w, F.struct(value, *then)).alias(f"_last_{w}") for w in weights if neighbours],
    )
    by_range = Window.partitionBy(*keys).orderBy("_range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = sums.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(f"_sum_{w}").over(earlier), F.lit(0)).alias(f"_offset_{w}") for w in weights],
        *[F.sum(f"_sum_{w}").over(whole).alias(f"total_{w}") for w in weights],
        *[F.lag(f"_last_{w}").over(by_range).alias(f"_previous_{w}") for w in weights if neighbours],
    )
    in_range = Window.partitionBy(*keys, "_range").orderBy(value, *then)
    inside = in_range.rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.select(
        "*",
        *[F.coalesce(F.sum(w).over(inside), F.lit(0)).alias(f"_inside_{w}") for w in weights],
        *[F.lag(w).over(in_range).alias(f"_lag_{w}") for w in weights if neighbours],
    )
    of = [f"_of_{at}" for at in range(len(keys))]
    offsets = offsets.withColumnsRenamed({**dict(zip(keys, of)), "_range": "_of_range"})
    summed = summed.join(F.broadcast(offsets), _same([*keys, "_range"], [*of, "_of_range"]))
    return summed.select(
        *[name for name in ranged.columns if name != "_range"],
        *[(F.col(f"_inside_{w}") + F.col(f"_offset_{w}")).alias(f"before_{w}") for w in weights],
        *[f"total_{w}" for w in weights],
        *[F.coalesce(f"_lag_{w}", f"_previous_{w}").alias(f"lower_{w}") for w in weights if neighbours],
    )


def quantile_columns(
    probabilities: Mapping[str, float], value: str = "value", weight: str = "n"
) -> dict[str, Column]:
    """Aggregates giving exact quantiles (linear interpolation) of a prefix-summed table."""
    before, total, count = F.col(f"before_{weight}"), F.col(f"total_{weight}"), F.col(weight)

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((before <= rank) & (rank < before + count), F.col(value)))

    out = {}
    for name, p in probabilities.items():
        position = F.lit(p) * (total - 1)
        low = at_rank(F.floor(position))
        high = at_rank(F.ceil(position))
        share = F.max(position - F.floor(position))
        out[name] = low + (high - low) * share
    return out


def weighted_moments(value: str = "value", weight: str = "n") -> dict[str, Column]:
    """Count, mean and sample standard deviation of a compressed table."""
    v, n = F.col(value), F.col(weight)
    count, total, squares = F.sum(n), F.sum(v * n), F.sum(v * v * n)
    spread = F.greatest(squares - total * total / count, F.lit(0.0))
    return {
        "count": count,
        "mean": total / count,
        "std": F.when(count > 1, F.sqrt(spread / (count - 1))),
    }


def group_summary(
    frame: DataFrame, keys: Sequence[str], metrics: Sequence[str], small_domain: bool = False
) -> DataFrame:
    """``keys…, metric, count, mean, median, std`` of every metric in every group."""
    counts = value_counts(long_values(frame, keys, metrics), [*keys, "metric"])
    ranked = prefix_sums(counts, [*keys, "metric"], ["n"], small_domain=small_domain)
    stats = weighted_moments() | quantile_columns({"median": 0.5})
    return ranked.groupBy(*keys, "metric").agg(*[agg.alias(name) for name, agg in stats.items()])


def widen(
    summary: DataFrame, keys: Sequence[str], metrics: Sequence[str], stats: Sequence[str]
) -> DataFrame:
    """One row per key with columns ``metric_stat`` from a group summary."""
    cells = [
        F.max(F.when(F.col("metric") == metric, F.col(stat))).alias(f"{metric}_{stat}")
        for metric in metrics
        for stat in stats
    ]
    return summary.groupBy(*keys).agg(*cells)
