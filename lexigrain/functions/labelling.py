"""Names and bins for labels, compound scores and effect sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexigrain.fixed_values import (
    CATEGORY_NAMES,
    EFFECT_SIZES,
    LARGEST_EFFECT,
    NEGATIVE_THRESHOLD,
    NEGATIVITY_EDGES,
    POSITIVE_THRESHOLD,
    SENTIMENT_LABELS,
)


def named(column: Column, names: Mapping[object, str]) -> Column:
    """Map a few values to names; anything else becomes null."""
    out = F.lit(None).cast("string")
    for value, name in names.items():
        out = F.when(column == value, F.lit(name)).otherwise(out)
    return out


def category(label: Column, names: Mapping[int, str] = CATEGORY_NAMES) -> Column:
    return named(label, names)


def sentiment_label(compound: Column) -> Column:
    negative, neutral, positive = SENTIMENT_LABELS
    return (
        F.when(compound >= POSITIVE_THRESHOLD, F.lit(positive))
        .when(compound <= NEGATIVE_THRESHOLD, F.lit(negative))
        .otherwise(F.lit(neutral))
    )


def negativity_score(compound: Column) -> Column:
    return F.when(compound < 0, -compound).otherwise(F.lit(0.0))


def right_closed_bin(value: Column, edges: Sequence[float] = NEGATIVITY_EDGES) -> Column:
    """Name of the bin ``(low, high]`` that holds the value; null outside the edges."""
    out = F.lit(None).cast("string")
    for low, high in reversed(list(zip(edges, edges[1:]))):
        out = F.when((value > low) & (value <= high), F.lit(f"({low}, {high}]")).otherwise(out)
    return out


def effect_size_name(delta: Column) -> Column:
    out = F.lit(LARGEST_EFFECT)
    for bound, name in reversed(EFFECT_SIZES):
        out = F.when(F.abs(delta) < bound, F.lit(name)).otherwise(out)
    return out
