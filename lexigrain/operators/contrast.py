"""Non-parametric contrast of two groups."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import pandas_udf

from lexigrain.fixed_values import BOOTSTRAP_RESAMPLES, CONFIDENCE, SEED
from lexigrain.functions.expressions import literal_array
from lexigrain.functions.labelling import effect_size_name
from lexigrain.operators.ranking import (
    even_cuts,
    long_values,
    place_among,
    prefix_over_ranges,
    prefix_sums,
    quantile_columns,
    range_bits,
    value_counts,
    weighted_moments,
    with_ranges,
)
from lexigrain.session import materialise

# Python workers get these few helpers by value, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A tie-free contrast whose smaller group has at most so many rows gets its exact distribution.
SMALL_GROUP = 8


def _group_counts(frame: DataFrame, metrics: Sequence[str], group: str) -> DataFrame:
    """``metric, value, n1, n0, n``: both groups side by side at every distinct value."""
    flag = F.when(F.col(group) == 1, 1).when(F.col(group) == 0, 0)
    long = long_values(frame.withColumn("_group", flag), ["_group"], metrics)
    return value_counts(
        long.where(F.col("_group").isNotNull()),
        ["metric"],
        counts={"n1": F.count_if(F.col("_group") == 1), "n0": F.count_if(F.col("_group") == 0)},
    )


def ranked_groups(
    frame: DataFrame, metrics: Sequence[str], group: str = "target", small_domain: bool = False
) -> DataFrame:
    counts = _group_counts(frame, metrics, group)
    return prefix_sums(counts, ["metric"], ["n1", "n0"], small_domain=small_domain)


def u_statistics() -> dict[str, Column]:
    """Group sizes, Mann–Whitney U of group 1 (ties count one half) and the tie term."""
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    tied = n1 + n0
    return {
        "n_group_1": F.sum("n1"),
        "n_group_0": F.sum("n0"),
        "u_statistic": F.sum(n1 * (F.col("before_n0") + n0 / 2)),
        "tie_term": F.sum(tied * tied * tied - tied),
    }


def _exact_tail(u: float, m: int, n: int) -> float:
    """P(U >= u) for two tie-free samples.

    The arrangements by U are the coefficients of a Gaussian binomial, built factor by factor
    from the lowest degree on, so even the smallest tail keeps its digits: m * m * n steps.
    """
    small, large = min(m, n), max(m, n)
    upper = math.ceil(u)
    turned = 2 * upper > small * large
    # U is symmetric: count the shorter side.
    degree = small * large - upper if turned else upper - 1
    if degree < 0:
        return 0.0 if turned else 1.0
    ways = np.zeros(degree + 1)
    ways[0] = 1.0
    for factor in range(1, small + 1):
        if large + factor <= degree:
            ways[large + factor :] -= ways[: degree + 1 - large - factor].copy()
        for start in range(min(factor, degree + 1)):
            ways[start::factor] = np.cumsum(ways[start::factor])
    side = min(1.0, float(ways.sum()) / math.comb(small + large, small))
    return side if turned else 1.0 - side


def _p_values(u: float, m: float, n: float, ties: float) -> tuple[float, float]:
    """Two-sided and one-sided (greater) p-value for one contrast."""
    if m == 0 or n == 0:
        return math.nan, math.nan
    larger = max(u, m * n - u)
    if min(m, n) <= SMALL_GROUP and ties == 0:
        two = min(1.0, 2 * _exact_tail(larger, int(m), int(n)))
        return two, _exact_tail(u, int(m), int(n))
    total = m + n
    variance = m * n / 12 * (total + 1 - ties / (total * (total - 1)))
    if variance <= 0:
        return 1.0, 1.0

    def tail(value: float) -> float:
        z = (value - m * n / 2 - 0.5) / math.sqrt(variance)
        return 0.5 * math.erfc(z / math.sqrt(2))

    return min(1.0, 2 * tail(larger)), tail(u)


_P_TYPE = T.StructType(
    [T.StructField("two_sided", T.DoubleType()), T.StructField("greater", T.DoubleType())]
)


@pandas_udf(_P_TYPE)
def p_values(u: pd.Series, m: pd.Series, n: pd.Series, ties: pd.Series) -> pd.DataFrame:
    """Runs on the one aggregated row per metric, never on data rows."""
    pairs = [_p_values(*row) for row in zip(u, m, n, ties)]
    return pd.DataFrame(pairs, columns=["two_sided", "greater"])


def _delta(u: str = "u_statistic") -> Column:
    return 2 * F.col(u) / (F.col("n_group_1").cast("double") * F.col("n_group_0")) - 1


def mann_whitney(
    frame: DataFrame, metrics: Sequence[str], group: str = "target", small_domain: bool = False
) -> DataFrame:
    ranked = ranked_groups(frame, metrics, group, small_domain)
    stats = ranked.groupBy("metric").agg(*[agg.alias(name) for name, agg in u_statistics().items()])
    p = p_values("u_statistic", F.col("n_group_1").cast("double"), F.col("n_group_0").cast("double"), "tie_term")
    return stats.withColumn("_p", p).select(
        "metric",
        "n_group_1",
        "n_group_0",
        "u_statistic",
        "tie_term",
        F.col("_p.two_sided").alias("p_two_sided"),
        F.col("_p.greater").alias("p_greater"),
    )


def cliffs_delta(
    frame: DataFrame, metrics: Sequence[str], group: str = "target", small_domain: bool = False
) -> DataFrame:
    ranked = ranked_groups(frame, metrics, group, small_domain)
    stats = ranked.groupBy("metric").agg(*[agg.alias(name) for name, agg in u_statistics().items()])
    return stats.select("metric", _delta().alias("cliffs_delta")).withColumn(
        "magnitude", effect_size_name(F.col("cliffs_delta"))
    )


def compare_groups(
    frame: DataFrame,
    metrics: Sequence[str],
    group: str = "target",
    resamples: int | None = BOOTSTRAP_RESAMPLES,
    seed: int = SEED,
    confidence: float = CONFIDENCE,
    small_domain: bool = False,
) -> DataFrame:
    """Full contrast, one row per metric; without resamples the interval columns are absent."""
    # Read by the contrast and by the bootstrap; far smaller than the rows behind it.
    counts = materialise(_group_counts(frame, metrics, group))
    ranked = prefix_sums(counts, ["metric"], ["n1", "n0"], small_domain=small_domain, stored=True)

    def of_group(k: int) -> dict[str, Column]:
        moments = weighted_moments(weight=f"n{k}")
        medians = quantile_columns({f"median_group_{k}": 0.5}, weight=f"n{k}")
        return {f"mean_group_{k}": moments["mean"], **medians}

    stats = u_statistics() | of_group(1) | of_group(0)
    row = ranked.groupBy("metric").agg(*[agg.alias(name) for name, agg in stats.items()])
    p = p_values("u_statistic", F.col("n_group_1").cast("double"), F.col("n_group_0").cast("double"), "tie_term")
    result = row.withColumn("_p", p).select(
        "metric",
        "n_group_1",
        "n_group_0",
        "mean_group_1",
        "mean_group_0",
        "median_group_1",
        "median_group_0",
        (F.col("mean_group_1") - F.col("mean_group_0")).alias("mean_difference"),
        (F.col("median_group_1") - F.col("median_group_0")).alias("median_difference"),
        "u_statistic",
        F.col("_p.two_sided").alias("p_two_sided"),
        F.col("_p.greater").alias("p_greater"),
        _delta().alias("cliffs_delta"),
        effect_size_name(_delta()).alias("magnitude"),
    )
    if resamples is None:
        return result
    intervals = _intervals(counts, metrics, resamples, seed, confidence)
    # One row per metric on both sides: the metric list bounds the broadcast.
    return result.join(F.broadcast(intervals), "metric")


def require_both_groups(contrast: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Raise when a metric lacks one of the two groups."""
    sizes = {r.metric: (r.n_group_1, r.n_group_0) for r in contrast.select("metric", "n_group_1", "n_group_0").collect()}
    if any(min(sizes.get(metric, (0, 0))) == 0 for metric in metrics):
        raise ValueError("both groups need at least one observation")
    return contrast


# --------------------------------------------------------------------------- bootstrap
#: Cells into which ranks are cut to look values up by an equality join.
RANK_CELLS = 1024
#: Draws held at once while a range of values is resampled.
DRAWS_HELD = 2_000_000


def bootstrap_intervals(
    frame: DataFrame,
    metrics: Sequence[str],
    group: str = "target",
    resamples: int = BOOTSTRAP_RESAMPLES,
    seed: int = SEED,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """Percentile intervals of the difference of means and of medians.

    Both are exact in distribution for any number of distinct values. A mean's n draws are split
    over ranges of values by a multinomial, and over the values of a range where that range
    is. A median's order statistics have Beta-distributed ranks, which are looked up in the
    prefix sums. NaN and infinite values raise.
    """
    counts = materialise(_group_counts(frame, metrics, group))
    return _intervals(counts, metrics, resamples, seed, confidence)


def _range_sums(
    part: pd.DataFrame,
    sizes: dict[tuple[str, int], np.ndarray],
    places: dict[str, int],
    resamples: int,
    seed: int,
) -> pd.DataFrame:
    """What one range of values adds to each replicate's two sums."""
    metric, at = part["metric"].iloc[0], int(part["_range"].iloc[0])
    part = part.sort_values("value")
    values = part["value"].to_numpy("float64")
    sums = []
    for group in (1, 0):
        of_range = sizes[metric, group]
        total = int(of_range.sum())
        # Every range draws the same split of the replicates over all ranges.
        split = np.random.default_rng([seed, places[metric], group])
        own = split.multinomial(total, of_range / total, size=resamples)[:, at]
        counts = part[f"n{group}"].to_numpy("int64")
        result = np.zeros(resamples)
        if counts.sum():
            inside = np.random.default_rng([seed, places[metric], group, at])
            step = max(1, DRAWS_HELD // len(values))
            for start in range(0, resamples, step):
                draws = inside.multinomial(own[start : start + step], counts / counts.sum())
                result[start : start + step] = draws @ values
        sums.append(result)
    return pd.DataFrame({"metric": metric, "replicate": np.arange(resamples), "sum1": sums[0], "sum0": sums[1]})


def _median_ranks(
    batches: Iterator[pd.DataFrame], totals: dict[tuple[str, int], int], places: dict[str, int], seed: int
) -> Iterator[pd.DataFrame]:
    """Per replicate the ranks (from 0) of the one or two middle values of each resample."""
    for batch in batches:
        rows = []
        for (metric, group), n in sorted(totals.items()):
            low = (n - 1) // 2 + 1
            for replicate in batch["id"]:
                generator = np.random.default_rng([seed, places[metric], group, 2, int(replicate)])
                place = generator.beta(low, n - low + 1)
                rows.append((metric, group, replicate, min(n - 1, int(n * place))))
                if n % 2 == 0:
                    place = 1 - (1 - place) * generator.random() ** (1 / (n - low))
                rows.append((metric, group, replicate, min(n - 1, int(n * place))))
        yield pd.DataFrame(rows, columns=["metric", "grp", "replicate", "rank"])


def _medians(ranked: DataFrame, ranks: DataFrame) -> DataFrame:
    """``metric, replicate, median_difference`` by looking ranks up in the prefix sums."""
    sides = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(k).alias("grp"),
                    F.col(f"n{k}").alias("n"),
                    F.col(f"before_n{k}").alias("before"),
                    F.col(f"total_n{k}").alias("total"),
                )
                for k in (1, 0)
            ]
        )
    )

    def cell(rank: Column) -> Column:
        return F.floor(rank.cast("double") * RANK_CELLS / F.col("total")).cast("int")

    held = ranked.select("metric", "value", sides.alias("s")).select("metric", "value", "s.*").where("n > 0")
    spanned = held.withColumn("last", F.col("before") + F.col("n") - 1).withColumn(
        "cell", F.explode(F.sequence(cell(F.col("before")), cell(F.col("last"))))
    )
    sizes = held.select("metric", "grp", "total").distinct()
    # One row per metric and group.
    placed = ranks.join(F.broadcast(sizes), ["metric", "grp"]).withColumn("cell", cell(F.col("rank"))).drop("total")
    found = placed.join(spanned, ["metric", "grp", "cell"]).where(F.col("rank").between(F.col("before"), F.col("last")))
    sign = F.when(F.col("grp") == 1, 0.5).otherwise(-0.5)
    return found.groupBy("metric", "replicate").agg(F.sum(sign * F.col("value")).alias("median_difference"))


def _intervals(
    counts: DataFrame, metrics: Sequence[str], resamples: int, seed: int, confidence: float
) -> DataFrame:
    spark = counts.sparkSession
    ranged = with_ranges(counts, ["metric"], "value")
    # One row per metric and range partition, however many rows or values there are.
    odd = F.isnan("value") | (F.abs("value") == float("inf"))
    ranges = ranged.groupBy("metric", "_range").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.bool_or(odd).alias("odd")
    ).collect()
    if any(row.odd for row in ranges):
        raise ValueError("bootstrap values must be finite")
    width = 1 + max((row._range for row in ranges), default=0)
    sizes = {(metric, k): np.zeros(width, dtype=np.int64) for metric in metrics for k in (1, 0)}
    for row in ranges:
        sizes[row.metric, 1][row._range] = row.n1
        sizes[row.metric, 0][row._range] = row.n0
    totals = {key: int(of_range.sum()) for key, of_range in sizes.items()}
    if any(total == 0 for total in totals.values()):
        raise ValueError("both groups need at least one observation")
    places = {metric: place for place, metric in enumerate(sorted(metrics))}

    def sums(part: pd.DataFrame) -> pd.DataFrame:
        return _range_sums(part, sizes, places, resamples, seed)

    parts = ranged.groupBy("metric", "_range").applyInPandas(
        sums, "metric string, replicate long, sum1 double, sum0 double"
    )
    means = parts.groupBy("metric", "replicate").agg(F.sum("sum1").alias("sum1"), F.sum("sum0").alias("sum0"))
    per_group = F.lit(None).cast("struct<n1:long,n0:long>")
    for metric in metrics:
        pair = F.struct(F.lit(totals[metric, 1]).alias("n1"), F.lit(totals[metric, 0]).alias("n0"))
        per_group = F.when(F.col("metric") == metric, pair).otherwise(per_group)
    means = means.select(
        "metric", "replicate", (F.col("sum1") / per_group["n1"] - F.col("sum0") / per_group["n0"]).alias("mean_difference")
    )
    tasks = max(1, min(resamples, spark.sparkContext.defaultParallelism))
    ranks = spark.range(0, resamples, 1, tasks).mapInPandas(
        partial(_median_ranks, totals=totals, places=places, seed=seed),
        "metric string, grp int, replicate long, rank long",
    )
    ranked = prefix_over_ranges(ranged, ["metric"], ["n1", "n0"], "value")
    draws = means.join(_medians(ranked, ranks), ["metric", "replicate"])
    tail = (1 - confidence) / 2
    ends = F.array(F.lit(tail), F.lit(1 - tail))
    return (
        draws.groupBy("metric")
        .agg(
            F.percentile("mean_difference", ends).alias("_mean"),
            F.percentile("median_difference", ends).alias("_median"),
        )
        .select(
            "metric",
            F.col("_mean")[0].alias("mean_ci_low"),
            F.col("_mean")[1].alias("mean_ci_high"),
            F.col("_median")[0].alias("median_ci_low"),
            F.col("_median")[1].alias("median_ci_high"),
        )
    )


# ------------------------------------------------------------------- rank correlation
def _with_rank(pairs: DataFrame, stored: DataFrame, value: str, other: str, rows: int) -> DataFrame:
    """``pairs`` with ``rank_<value>``: ties share the mean of their ranks.

    ``stored`` holds the same ``x, y, n`` rows and is only summed. A value that is itself a cut point has a range
    of its own, whose sums alone give its rank, so such a range is split by the other column
    into as many parts as the value fills cuts: one value may hold any share of the pairs.
    """
    bits, x = range_bits(rows), F.col(value)
    below, own, filled = F.lit(0), F.lit(False), F.lit(1)
    if bits:
        cuts = literal_array(even_cuts(stored, x, bits))
        below = place_among(x, cuts, bits)
        own = F.coalesce(F.get(cuts, F.col("_below")) == x, F.lit(False))
        # By binary search like the place, so that a row's work does not grow with the number of cuts.
        filled = place_among(x, cuts, bits, equal=True) - F.col("_below")

    def placed(frame: DataFrame) -> DataFrame:
        # Ranges are numbered in order; odd ones hold one value.
        found = frame.withColumn("_below", below).withColumn("_own", own)
        return found.withColumn("_range", 2 * F.col("_below") + F.col("_own").cast("int"))

    sums = placed(stored).groupBy("_range").agg(F.sum("n").alias("_in_range"))
    order = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sums.select(
        F.col("_range").alias("_of"), "_in_range", F.coalesce(F.sum("_in_range").over(order), F.lit(0)).alias("_before")
    )
    part = F.when(F.col("_own"), F.pmod(F.xxhash64(other), F.greatest(filled, F.lit(1)))).otherwise(F.lit(0))
    split = placed(pairs).withColumn("_part", part)
    inside = Window.partitionBy("_range", "_part")
    reached = F.sum("n").over(inside.orderBy(value))  # with all equal values
    ties = F.sum("n").over(Window.partitionBy("_range", "_part", value))
    local = split.withColumns({"_reached": reached, "_ties": ties})
    met = local.join(F.broadcast(offsets), F.col("_range") == F.col("_of"))
    rank = F.when(F.col("_own"), F.col("_before") + (F.col("_in_range") + 1) / 2).otherwise(
        F.col("_before") + F.col("_reached") - F.col("_ties") + (F.col("_ties") + 1) / 2
    )
    return met.withColumn(f"rank_{value}", rank).select(*pairs.columns, f"rank_{value}")


def spearman(
    frame: DataFrame, left: str, right: str, small_domain: bool = False, weight: Column | None = None
) -> DataFrame:
    """Rank correlation of two columns as a one-row table.

    Rows are compressed to distinct pairs, which are stored; ranks are attached in one pass over ranges
    of each side's values, without a join by value.
    """
    pairs = (
        frame.select(
            F.col(left).cast("double").alias("x"),
            F.col(right).cast("double").alias("y"),
            (F.lit(1).cast("long") if weight is None else weight).alias("w"),
        )
        .na.drop()
        .groupBy("x", "y")
        .agg(F.sum("w").alias("n"))
    )
    pairs = materialise(pairs)
    rows = 0 if small_domain else pairs.count()
    joined = _with_rank(_with_rank(pairs, pairs, "x", "y", rows), pairs, "y", "x", rows)
    n, a, b = F.col("n").cast("double"), F.col("rank_x"), F.col("rank_y")
    sums = joined.agg(
        F.sum(n).alias("n"),
        F.sum(n * a).alias("a"),
        F.sum(n * b).alias("b"),
        F.sum(n * a * b).alias("ab"),
        F.sum(n * a * a).alias("aa"),
        F.sum(n * b * b).alias("bb"),
    )
    covariance = F.col("ab") - F.col("a") * F.col("b") / F.col("n")
    spread = (F.col("aa") - F.col("a") * F.col("a") / F.col("n")) * (
        F.col("bb") - F.col("b") * F.col("b") / F.col("n")
    )
    return sums.select(F.when(spread > 0, covariance / F.sqrt(spread)).alias("correlation"))


def negativity_audit(sentiment: DataFrame, small_domain: bool = True) -> DataFrame:
    """Range, centre and rank correlations of the negativity score, ``indicator, value``.

    The score has four decimals, so its value domain is small by construction.
    """
    measures = ("negativity", "sentiment_negative", "target")
    # One pass over the texts; everything below reads the compressed table.
    joint = materialise(sentiment.groupBy(*measures).agg(F.count(F.lit(1)).alias("rows")))
    counts = value_counts(
        long_values(joint, ["rows"], ["negativity"]), ["metric"], counts={"n": F.sum("rows")}
    )
    ranked = prefix_sums(counts, ["metric"], ["n"], small_domain=small_domain)
    moments = weighted_moments()
    n = F.col("n")
    stats = {
        "minimum": F.min("value"),
        "maximum": F.max("value"),
        "mean": moments["mean"],
        "median": quantile_columns({"median": 0.5})["median"],
        "std": moments["std"],
        "zero_documents": F.sum(F.when(F.col("value") == 0, n).otherwise(0)),
        "zero_pct": 100 * F.sum(F.when(F.col("value") == 0, n).otherwise(0)) / F.sum(n),
    }
    row = ranked.agg(*[value.cast("double").alias(name) for name, value in stats.items()])
    correlations = {
        "spearman_negative": spearman(
            joint, "negativity", "sentiment_negative", small_domain, F.col("rows")
        ),
        "spearman_target": spearman(joint, "negativity", "target", small_domain, F.col("rows")),
    }
    row = row.withColumns({name: table.scalar() for name, table in correlations.items()})
    return row.unpivot([], row.columns, "indicator", "value")
