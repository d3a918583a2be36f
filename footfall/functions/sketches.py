"""Approximate order statistics by mergeable sketches, for who asks for them.

A sketch (KLL) holds some hundred values of a group however large the group is, and
sketches of parts of a group merge to one of the whole: of a user's stretches to a
window, of days to a month. A quantile taken from it has a rank off by at most
``rank_error(k)`` of the number of values, with a confidence of 99 %. Up to ``k`` values
are kept as they are, so small groups are exact. ``quantiles`` stays the default: its
results are exact and the same on every run, a large group's sketch need not be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.names import BOXPLOT_POINTS

#: Size of a sketch.
K = 800


def rank_error(k: int = K) -> float:
    """Share of all values that a quantile's rank may be off by."""
    return 2.296 / k**0.9723


def sketches(rows: DataFrame, by: Sequence[str], value: str, k: int = K) -> DataFrame:
    """A sketch per group and its number of values; NULL and NaN values are left out."""
    number = F.col(value).cast("double")
    return (
        rows.where(number.isNotNull() & ~F.isnan(number))
        .groupBy(*by)
        .agg(F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n"))
    )


def merged(parts: DataFrame, by: Sequence[str], k: int = K) -> DataFrame:
    """Sketches of groups from sketches of their parts."""
    return parts.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("n").alias("n"))


def sketch_quantiles(
    parts: DataFrame, by: Sequence[str], points: Sequence[float] = BOXPLOT_POINTS, name: str = "boxplot", total: str | None = None
) -> DataFrame:
    """One row per group with an array of order statistics, shaped as ``quantiles`` gives it."""
    values = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in points])
    return parts.select(*by, values.alias(name), *([F.col("n").alias(total)] if total else []))


def approximate_quantiles(
    rows: DataFrame, by: Sequence[str], value: str, points: Sequence[float] = BOXPLOT_POINTS,
    name: str = "boxplot", total: str | None = None, parts: Sequence[str] = (), k: int = K,
) -> DataFrame:
    """``quantiles`` by sketches, one for each of ``parts`` of a group first where they are given."""
    found = sketches(rows, [*by, *parts], value, k)
    return sketch_quantiles(merged(found, by, k) if parts else found, by, points, name, total)
