"""Hot users are found, cut evenly, and come back whole."""

from pyspark.sql import functions as F

from footfall.plans import skew
from footfall.plans.scan import HighestBefore, LastKnown, NextKnown, Previous, RunningSum, scan


def steps():
    return {
        "sum": RunningSum(F.col("s")), "previous": Previous(F.col("v")), "last": LastKnown(F.col("v")),
        "until": LastKnown(F.col("v"), inclusive=True), "next": NextKnown(F.col("v")), "high": HighestBefore(F.col("v")),
    }


def uneven(spark):
    """User 1 has 4,000 of 4,400 rows, half of them within two minutes."""
    burst = spark.range(2000).select(F.lit(1).cast("bigint").alias("u"), (F.col("id") % 120).alias("s"))
    calm = spark.range(2000).select(F.lit(1).cast("bigint").alias("u"), (1000 + F.col("id") * 60).alias("s"))
    rest = spark.range(400).select((2 + F.col("id") % 40).alias("u"), (F.col("id") * 500).alias("s"))
    rows = burst.unionByName(calm).unionByName(rest)
    return rows.withColumn("event_id", F.monotonically_increasing_id()).withColumn(
        "at", F.timestamp_seconds("s")
    ).cache()


def test_no_hot_user(spark):
    assert skew.find_hot(uneven(spark), "u", "at", max_rows=5000) is None


def test_slices_are_even_and_in_order(spark):
    rows = uneven(spark)
    hot = skew.find_hot(rows, "u", "at", max_rows=100, unit_seconds=1)
    cut = skew.add_slice(rows, hot, "u", "at")
    assert cut.where("u <> 1 AND slice <> 0").isEmpty()
    slices = cut.where("u = 1").groupBy("slice").agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"))
    slices = slices.orderBy("slice").collect()
    assert [r.slice for r in slices] == list(range(1, len(slices) + 1)) and len(slices) >= 30
    assert sum(r.n for r in slices) == 4000 and max(r.n for r in slices) <= 120
    assert all(a.hi < b.lo for a, b in zip(slices, slices[1:]))


def test_every_user_can_be_hot_and_cuts_are_kept_by_day(spark):
    rows = uneven(spark)
    hot = skew.find_hot(rows, "u", "at", max_rows=1, unit_seconds=1)
    assert hot.cuts.select("userid").distinct().count() == 41
    assert hot.cuts.count() == rows.select("u", F.to_date("at")).distinct().count()
    assert hot.slices.count() == rows.select("u", "s").distinct().count()


def test_two_thousand_hot_users_over_two_years(spark):
    """Far more hot users and slices than were once allowed; nothing of them reaches the driver."""
    rows = spark.range(2000 * 70).select(
        (F.col("id") % 2000).cast("string").alias("userid"), F.pmod(F.xxhash64("id"), F.lit(730 * 86400)).alias("s"), F.col("id").alias("event_id"),
    ).withColumn("at", F.timestamp_seconds("s")).withColumn("v", F.when(F.col("event_id") % 5 == 0, F.col("s"))).cache()
    hot = skew.find_hot(rows, "userid", "at", max_rows=9)
    assert hot.slices.select("userid").distinct().count() == 2000
    assert hot.slices.agg(F.max("slice")).first()[0] == 8
    cut = skew.add_slice(rows, hot, at="at").cache()
    assert cut.where("slice = 0").isEmpty()
    split = scan(cut, ["userid"], ["s", "event_id"], steps(), sliced=True).cache()
    whole = scan(cut, ["userid"], ["s", "event_id"], steps(), sliced=False).select(*split.columns)
    assert split.count() == 140_000 and split.exceptAll(whole).isEmpty()


def test_carries_go_through_groups_of_slices(spark, monkeypatch):
    monkeypatch.setattr("footfall.plans.scan.GROUP", 3)
    rows = uneven(spark).withColumn("v", F.when(F.col("event_id") % 31 < 2, F.col("event_id")))
    cut = skew.add_slice(rows, skew.find_hot(rows, "u", "at", max_rows=50, unit_seconds=1), "u", "at")
    split = scan(cut, ["u"], ["s", "event_id"], steps(), sliced=True)
    whole = scan(cut, ["u"], ["s", "event_id"], steps(), sliced=False).select(*split.columns)
    assert split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()


def test_slices_need_no_driver(spark):
    import inspect

    from footfall.plans import scan as scans

    for module in (skew, scans):
        text = inspect.getsource(module)
        assert not any(word in text for word in (".collect()", ".limit(", "broadcast(", "toPandas", ".take("))


def test_joins_with_spread_users_are_whole(spark):
    rows = uneven(spark).withColumn("userid", F.col("u").cast("string"))
    hot = skew.find_hot(rows, "u", "at", max_rows=100)
    cut = skew.add_slice(rows, hot, at="at")
    users = rows.select("userid").distinct().where("userid <> '2'").withColumn("x", F.col("userid"))
    assert skew.join_users(cut, users, hot).count() == rows.where("u <> 2").count()
    assert skew.join_users(cut, users.drop("x"), hot, "left_semi").count() == rows.where("u <> 2").count()


def test_scan_of_slices_equals_scan_of_whole_users(spark):
    rows = uneven(spark).withColumn("v", F.when(F.col("event_id") % 7 < 2, F.col("event_id")))
    hot = skew.find_hot(rows, "u", "at", max_rows=50, unit_seconds=1)
    cut = skew.add_slice(rows, hot, "u", "at")
    steps = {
        "sum": RunningSum(F.col("s")), "previous": Previous(F.col("v")), "last": LastKnown(F.col("v")),
        "until": LastKnown(F.col("v"), inclusive=True), "next": NextKnown(F.col("v")),
    }
    order = ["s", "event_id"]
    split = scan(cut, ["u"], order, steps, sliced=True)
    whole = scan(cut, ["u"], order, steps, sliced=False).select(*split.columns)
    assert split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(u" in plan and "slice" in plan.split("hashpartitioning(u")[1][:20]
