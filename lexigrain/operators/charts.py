"""The numbers behind the figures; nothing is drawn."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrain.operators.ranking import prefix_sums, quantile_columns, value_counts, weighted_moments
from lexigrain.session import materialise


#: Bandwidths a kernel reaches.
REACH = 8.0


def _values(frame: DataFrame, metric: str, group: str) -> DataFrame:
    value = F.col(metric).cast("double")
    return frame.select(F.col(group).alias("group"), value.alias("value")).na.drop()


def density_histogram(frame: DataFrame, metric: str, bins: int, group: str = "target") -> DataFrame:
    """Equal bins over the common range; the density of each group integrates to one."""
    distinct = materialise(value_counts(_values(frame, metric, group), ["group"]))
    span = distinct.agg(F.min("value").alias("low"), F.max("value").alias("high")).first()
    low, width = span.low or 0.0, ((span.high or 0.0) - (span.low or 0.0)) / bins
    slot = F.least(F.floor((F.col("value") - low) / width), F.lit(bins - 1)) if width else F.lit(0)
    counts = distinct.groupBy("group", slot.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    # A group has at most ``bins`` counts, so gathering them fills the gaps with zero.
    filled = counts.groupBy("group").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"), F.sum("n").alias("_all")
    )
    return filled.select(
        F.col("group").alias(group), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_n", "_all"
    ).select(
        group,
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("bin_start"),
        F.coalesce(F.try_element_at("_n", F.col("bin")), F.lit(0)).alias("documents"),
        (F.coalesce(F.try_element_at("_n", F.col("bin")), F.lit(0)) / (F.col("_all") * (width or 1.0))).alias("density"),
    )


def _ranked(frame: DataFrame, metric: str, group: str, small_domain: bool) -> DataFrame:
    counts = value_counts(_values(frame, metric, group), ["group"])
    if small_domain:
        counts = materialise(counts)
    return prefix_sums(counts, ["group"], ["n"], small_domain=small_domain)


def box_statistics(frame: DataFrame, metric: str, group: str = "target", small_domain: bool = False) -> DataFrame:
    """Quartiles and whiskers (furthest values within 1.5 box lengths) per group."""
    ranked = _ranked(frame, metric, group, small_domain)
    quartiles = quantile_columns({"q1": 0.25, "median": 0.5, "q3": 0.75})
    boxes = ranked.groupBy("group").agg(*[value.alias(name) for name, value in quartiles.items()])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    # One row per group.
    joined = ranked.join(F.broadcast(boxes), "group")
    return joined.groupBy(F.col("group").alias(group), "q1", "median", "q3").agg(
        F.min(F.when(F.col("value") >= F.col("q1") - reach, F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= F.col("q3") + reach, F.col("value"))).alias("whisker_high"),
    )


def ecdf(frame: DataFrame, metric: str, group: str = "target", small_domain: bool = False) -> DataFrame:
    """Share of a group at or below each of its distinct values."""
    ranked = _ranked(frame, metric, group, small_domain)
    return ranked.select(
        F.col("group").alias(group),
        "value",
        ((F.col("before_n") + F.col("n")) / F.col("total_n")).alias("proportion"),
    )


def kernel_density(
    frame: DataFrame, metric: str, group: str = "target", points: int = 200, cut: float = 3.0
) -> DataFrame:
    """Gaussian kernel density on an even grid per group, Scott's bandwidth.

    A distinct value adds only to the grid points within REACH bandwidths, beyond which a kernel is below
    1e-13 of its height; sums are combined before the shuffle, so only the grid travels.
    """
    counts = materialise(value_counts(_values(frame, metric, group), ["group"]))
    moments = weighted_moments()
    width = moments["std"] * F.pow(moments["count"], F.lit(-0.2))
    shape = counts.groupBy("group").agg(
        moments["count"].alias("_n"), width.alias("_width"), F.min("value").alias("_low"), F.max("value").alias("_high")
    )
    # One row per group; a group without spread has no density.
    start = F.col("_low") - cut * F.col("_width")
    step = (F.col("_high") - F.col("_low") + 2 * cut * F.col("_width")) / (points - 1)
    shape = materialise(
        shape.where(F.col("_width") > 0).withColumns({"_start": start, "_step": step}).drop("_low", "_high")
    )
    place, reach = (F.col("value") - F.col("_start")) / F.col("_step"), REACH * F.col("_width") / F.col("_step")
    first = F.greatest(F.ceil(place - reach), F.lit(0)).cast("int")
    last = F.least(F.floor(place + reach), F.lit(points - 1)).cast("int")
    near = counts.join(F.broadcast(shape), "group").select("*", F.explode(F.sequence(first, last)).alias("point"))
    x = F.col("_start") + F.col("point") * F.col("_step")
    z = (x - F.col("value")) / F.col("_width")
    sums = near.groupBy("group", "point").agg(F.sum(F.col("n") * F.exp(-0.5 * z * z)).alias("_sum"))
    grid = shape.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    height = F.coalesce("_sum", F.lit(0.0)) / (F.col("_n") * F.col("_width") * math.sqrt(2 * math.pi))
    return grid.join(F.broadcast(sums), ["group", "point"], "left").select(
        F.col("group").alias(group), "point", x.alias("x"), height.alias("density")
    )
