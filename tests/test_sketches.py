"""Sketches stay within their bound on skewed data, whole and merged from parts."""

import pytest
from pyspark.sql import functions as F

from footfall.functions.quantiles import quantiles
from footfall.functions.sketches import K, approximate_quantiles, merged, rank_error, sketch_quantiles, sketches

POINTS = (0.0, 0.02, 0.25, 0.5, 0.75, 0.98, 1.0)


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with 95 % of 200,000 rows; values from a steep power law, a third of them equal."""
    unit = (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) + 1) / 1_000_004
    return spark.range(200_000).select(
        F.when(F.col("id") % 20 == 0, F.col("id") % 7).otherwise(100).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise(F.pow(unit, F.lit(-2.5))).alias("v"), (F.col("id") % 40).alias("part"),
    ).cache()


@pytest.mark.parametrize("parts", [[], ["part"]])
def test_rank_error_is_bounded(skewed, parts):
    got = approximate_quantiles(skewed, ["g"], "v", POINTS, total="n", parts=parts)
    each = got.select("g", "n", F.posexplode("boxplot").alias("i", "q"))
    ranks = skewed.join(each, "g").groupBy("g", "i", "n").agg(F.count_if(F.col("v") < F.col("q")).alias("a"), F.count_if(F.col("v") <= F.col("q")).alias("b"))
    rows = ranks.collect()
    assert len(rows) == 8 * len(POINTS) and sum(r.n for r in rows if r.i == 0) == 200_000
    for r in rows:
        assert r.a / r.n - 2 * rank_error() <= POINTS[r.i] <= r.b / r.n + 2 * rank_error()


def test_small_groups_are_exact(spark):
    rows = spark.range(K // 2).select(F.lit("x").alias("g"), (F.col("id") * F.col("id")).alias("v"))
    got = approximate_quantiles(rows, ["g"], "v").first()["boxplot"]
    assert got == [float(v) for v in quantiles(rows, ["g"], "v").first()["boxplot"]]


def test_windows_merge_from_stretches_and_odd_values_stay_out(spark):
    rows = spark.createDataFrame([("a", s, float(v)) for s in range(4) for v in range(s + 1)] + [("a", 0, None), ("a", 1, float("nan"))], "g string, stretch int, v double")
    parts = sketches(rows, ["g", "stretch"], "v")
    windows = parts.withColumn("window", F.explode(F.sequence(F.col("stretch"), F.lit(3)))).drop("stretch")
    got = {r.window: (r.n, r.boxplot) for r in sketch_quantiles(merged(windows, ["g", "window"]), ["g", "window"], (0.5, 1.0), total="n").collect()}
    assert got == {0: (1, [0.0, 0.0]), 1: (3, [0.0, 1.0]), 2: (6, [0.0, 2.0]), 3: (10, [1.0, 3.0])}
    assert approximate_quantiles(rows.limit(0), ["g"], "v").count() == 0
