"""Exact order statistics that never hold a whole group in one task.

Values are counted per (group, value), counted again per coarse bin, and only
the rows of the bins that contain a wanted rank are ordered. Bins are a fixed
monotone function of the value, so a rerun task sees the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.names import BOXPLOT_POINTS

BINS_PER_OCTAVE = 64


def disc_rank(p: Column, total: Column) -> Column:
    """1-based rank of ``percentile_disc``: the first value whose share reaches p."""
    return F.greatest(F.ceil(p * total), F.lit(1)).cast("bigint")


def index_rank(p: Column, total: Column) -> Column:
    """1-based rank of the boxplot rule: zero-based index ``round(p * (n - 1))``."""
    return (F.round(p * (total - 1)) + 1).cast("bigint")


RANK_RULES = {"disc": disc_rank, "index": index_rank}


def value_bin(value: Column) -> Column:
    """Monotone bin: 64 steps per doubling of the value, mirrored below zero, NaN last.

    The offset keeps the smallest doubles (2^-1074) above the bin of zero.
    """
    number = value.cast("double")
    size = F.when(number == 0, F.lit(0)).otherwise(F.floor((F.log2(F.abs(number)) + 1100) * BINS_PER_OCTAVE)).cast("bigint")
    return F.when(F.isnan(number), F.lit(2**63 - 1)).when(number < 0, -size).otherwise(size)


def _counted(rows: DataFrame, by: Sequence[str], value: str, weight: str | None) -> DataFrame:
    number = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        rows.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_value"))
        .agg(number.alias("_n"))
    )


def _ranks(points: Sequence[float], rule: str, total: Column) -> Column:
    """Array of (index of the point, wanted rank)."""
    rank_of = RANK_RULES[rule]
    return F.array(*[
        F.struct(F.lit(i).alias("i"), rank_of(F.lit(float(p)), total).alias("rank"))
        for i, p in enumerate(points)
    ])


def _collected(hits: DataFrame, by: Sequence[str], name: str, total: str | None) -> DataFrame:
    """One array per group from rows of (index, value)."""
    out = [
        F.transform(
            F.array_sort(F.collect_list(F.struct("_i", "_value"))), lambda e: e["_value"]
        ).alias(name)
    ]
    if total:
        out.append(F.max("_total").alias(total))
    return hits.groupBy(*by).agg(*out)


def quantiles(
    rows: DataFrame,
    by: Sequence[str],
    value: str,
    points: Sequence[float] = BOXPLOT_POINTS,
    rule: str = "disc",
    name: str = "boxplot",
    total: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row per group with an array of the wanted order statistics.

    NULL values are ignored; a group without any other value gives no row.
    ``total`` names a column for the number of values. With ``weight`` each row
    stands for that many equal values.
    """
    by = list(by)
    counted = _counted(rows, by, value, weight).withColumn("_bin", value_bin(F.col("_value")))
    group = Window.partitionBy(*by)
    bins = (
        counted.groupBy(*by, "_bin")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(group.orderBy("_bin")))
        .withColumn("_total", F.sum("_n").over(group))
    )
    before = F.col("_upto") - F.col("_n")
    upto = F.col("_upto")
    targets = bins.select(
        *by, "_bin", "_total",
        # ranks that fall into this bin, counted from its start
        F.transform(
            F.filter(
                _ranks(points, rule, F.col("_total")),
                lambda t: (t["rank"] <= upto) & (t["rank"] > before),
            ),
            lambda t: F.struct(t["i"].alias("i"), (t["rank"] - before).alias("rank")),
        ).alias("_ranks"),
    ).where(F.size("_ranks") > 0)
    # null-safe throughout: a null filter on one side would keep the two sides
    # from sharing the counts' shuffle
    same_bin = [F.col(f"c.{c}").eqNullSafe(F.col(f"t.{c}")) for c in (*by, "_bin")]
    # the targets are the small side: at most one row per group and point
    near = counted.alias("c").join(targets.alias("t").hint("shuffle_hash"), same_bin).select(*[F.col(f"c.{c}").alias(c) for c in by], "c._bin", "_value", "_n", "_total", "_ranks")
    inside = Window.partitionBy(*by, "_bin").orderBy("_value")
    hits = (
        near.withColumn("_upto", F.sum("_n").over(inside))
        .withColumn("_hit", F.filter("_ranks", lambda t: (t["rank"] <= upto) & (t["rank"] > before)))
        .where(F.size("_hit") > 0)
        .select(*by, "_value", "_total", F.explode("_hit.i").alias("_i"))
    )
    return _collected(hits, by, name, total)


def count_quantiles(
    rows: DataFrame,
    by: Sequence[str],
    value: str,
    points: Sequence[float] = BOXPLOT_POINTS,
    rule: str = "disc",
    name: str = "boxplot",
    total: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """The same for values that count events.

    Such a value v stands for v events, so N events make at most sqrt(2 N)
    distinct values: the counts of one group fit one task and need no bins.
    """
    by = list(by)
    group = Window.partitionBy(*by)
    upto = F.col("_upto")
    hits = (
        _counted(rows, by, value, weight)
        .withColumn("_upto", F.sum("_n").over(group.orderBy("_value")))
        .withColumn("_total", F.sum("_n").over(group))
        .withColumn(
            "_hit",
            F.filter(
                _ranks(points, rule, F.col("_total")),
                lambda t: (t["rank"] <= upto) & (t["rank"] > upto - F.col("_n")),
            ),
        )
        .where(F.size("_hit") > 0)
        .select(*by, "_value", "_total", F.explode("_hit.i").alias("_i"))
    )
    return _collected(hits, by, name, total)


def boxplot_array(values: Column, points: Sequence[float] = BOXPLOT_POINTS) -> Column:
    """Boxplot rule over an array column that is already small, such as one row's list."""
    ordered = F.array_sort(values)
    last = F.size(values) - 1
    return F.when(
        F.size(values) > 0,
        F.array(*[F.get(ordered, F.round(F.lit(float(p)) * last).cast("int")) for p in points]),
    )
