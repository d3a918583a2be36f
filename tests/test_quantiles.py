import math
import random

import pytest
from pyspark.sql import functions as F

from footfall.functions.quantiles import boxplot_array, count_quantiles, quantiles

POINTS = (0.0, 0.02, 0.25, 0.5, 0.75, 0.98, 1.0)


def brute(values, rule):
    v, n = sorted(values), len(values)
    if rule == "disc":
        return [v[max(math.ceil(p * n), 1) - 1] for p in POINTS]
    return [v[math.floor(p * (n - 1) + 0.5)] for p in POINTS]


@pytest.mark.parametrize("rule", ["disc", "index"])
def test_against_sorted_lists(spark, rule):
    rnd = random.Random(3)
    groups = {
        "ints": [rnd.randint(0, 5) for _ in range(400)],
        "wide": [rnd.uniform(-1e9, 1e9) for _ in range(777)],
        "small": [rnd.uniform(-1e-3, 1e-3) for _ in range(50)],
        "one": [7.0],
        None: [1.0, 2.0, 3.0, 4.0],
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("ints", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for function in (quantiles, count_quantiles):
        rows = function(df, ["g"], "v", POINTS, rule, total="n").collect()
        assert {r.g: list(r.boxplot) for r in rows} == {
            g: brute([float(v) for v in vs], rule) for g, vs in groups.items()
        }
        assert {r.g: r.n for r in rows} == {g: len(vs) for g, vs in groups.items()}


def test_the_two_rules_differ(spark):
    df = spark.createDataFrame([(1, v) for v in (10, 20, 30, 40)], "g int, v int")
    pick = lambda rule: quantiles(df, ["g"], "v", (0.5,), rule).first().boxplot[0]
    assert (pick("disc"), pick("index")) == (20, 30)
    row = spark.range(1).select(boxplot_array(F.array(*map(F.lit, (40, 10, 30, 20))), (0.5,)).alias("b")).first()
    assert row.b == [30]


def test_bins_follow_the_value_with_fractions_and_nan(spark):
    from pyspark.sql import functions as F

    from footfall.functions.quantiles import value_bin

    values = [-4.0, -0.5, -1e-9, 0.0, 1e-300, 1e-9, 0.001, 0.002, 0.5, 1.0, 7.0, float("inf"), float("nan")]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    bins = [r.b for r in rows.select("k", value_bin(F.col("v")).alias("b")).orderBy("k").collect()]
    assert bins == sorted(bins) and len(set(bins[:11])) == 11
    fractions = spark.range(100_000).select((F.col("id") / 1e7).alias("v"))
    assert fractions.select(value_bin(F.col("v"))).distinct().count() > 500
