"""Splitting the histories of hot users.

Most operators work per user. A user with a large share of all rows would land
in one task, so such users are found first (one map-side combined count) and
their history is cut into time slices of even size. ``slice`` is 0 for all other
users, which are left alone.

Any number of users may be hot and any number of slices may come of one: counts,
cuts and slices are tables. A user's rows are counted per unit of time, units are
added up within a day and days within the user, so no window here holds more than
the units of a day or the days of a log. Lookups join on (user, day); Spark
broadcasts the cuts when their file is small and shuffles both sides when not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.session import stored

MAX_ROWS = 500_000
UNIT_SECONDS = 60
DAY_SECONDS = 86_400


@dataclass(frozen=True)
class HotKeys:
    """Hot keys: per day the units at which a slice begins, and all slices.

    ``cuts``: userid, day, cuts array<struct<unit, slice>>, the first one of a day
    being the slice that goes on from the day before. ``slices``: userid, slice.
    They hold for the events they were made from and for any part of them.
    """

    cuts: DataFrame
    slices: DataFrame
    unit_seconds: int


def _seconds(at: Column) -> Column:
    return F.unix_seconds(at.cast("timestamp"))


def _unit(at: Column, unit_seconds: int) -> Column:
    return F.floor(_seconds(at) / unit_seconds)


def _day(unit: Column, unit_seconds: int) -> Column:
    return F.floor(unit * unit_seconds / DAY_SECONDS).cast("int")


def find_hot(
    events: DataFrame,
    key: str,
    at: str,
    max_rows: int = MAX_ROWS,
    unit_seconds: int = UNIT_SECONDS,
) -> HotKeys | None:
    """Keys with more than ``max_rows`` rows, and cuts that even out their slices.

    Runs one job over two columns of ``events``; others only when there is a hot key. Returns None when no key is hot. A unit is never cut.
    """
    users = events.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    hot = (
        users.groupBy(F.col(key).cast("string").alias("userid"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > max_rows)
    )
    if hot.isEmpty():
        return None
    hot = stored(hot.select("userid"))
    units = stored(
        users.select(F.col(key).cast("string").alias("userid"), _unit(F.col(at), unit_seconds).alias("unit"))
        .join(hot, "userid", "left_semi")
        .groupBy("userid", "unit")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("day", _day(F.col("unit"), unit_seconds))
    )
    of_day = Window.partitionBy("userid", "day").orderBy("unit")
    of_user = Window.partitionBy("userid").orderBy("day")
    days = units.groupBy("userid", "day").agg(F.sum("n").alias("n"))
    days = days.select("userid", "day", (F.sum("n").over(of_user) - F.col("n")).alias("before"))
    inside = units.select("userid", "day", "unit", (F.sum("n").over(of_day) - F.col("n")).alias("inside"))
    piece = F.floor((F.col("before") + F.col("inside")) / max_rows).cast("int") + 1
    starts = inside.join(days, ["userid", "day"]).groupBy("userid", "day", piece.alias("slice")).agg(F.min("unit").alias("unit"))
    starts = stored(starts)
    cuts = starts.groupBy("userid", "day").agg(F.array_sort(F.collect_list(F.struct("unit", "slice"))).alias("cuts"))
    return HotKeys(stored(cuts), stored(starts.select("userid", "slice").distinct()), unit_seconds)


def add_slice(events: DataFrame, hot: HotKeys | None, key: str = "userid", at: str = "created_at") -> DataFrame:
    """Add ``slice``: 0 for normal users, 1.. in time order for hot ones."""
    if hot is None:
        return events.withColumn("slice", F.lit(0))
    cuts = hot.cuts.select(F.col("userid").alias("_hot"), F.col("day").alias("_day"), F.col("cuts").alias("_cuts"))
    unit = _unit(F.col(at), hot.unit_seconds)
    # how many cuts of the day have been reached, by halving steps
    most = max(1, DAY_SECONDS // hot.unit_seconds + 1).bit_length()
    steps = [1 << i for i in reversed(range(most))]
    reached = F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda done, step: F.when(F.get("_cuts", done + step - 1)["unit"] <= unit, done + step).otherwise(done),
    )
    return (
        events.join(cuts, (F.col(key).cast("string") == F.col("_hot")) & (_day(unit, hot.unit_seconds) == F.col("_day")), "left")
        .withColumn("slice", F.when(F.col("_cuts").isNotNull(), F.get("_cuts", F.greatest(reached, F.lit(1)) - 1)["slice"]).otherwise(0))
        .drop("_hot", "_day", "_cuts")
    )


def spread(per_user: DataFrame, hot: HotKeys | None, key: str = "userid") -> DataFrame:
    """Copy the rows of hot users to each of their slices, for joins on (user, slice)."""
    if hot is None:
        return per_user.withColumn("slice", F.lit(0))
    slices = hot.slices.select(F.col("userid").alias("_hot"), F.col("slice").alias("_slice"))
    return (
        per_user.join(slices, F.col(key).cast("string") == F.col("_hot"), "left")
        .withColumn("slice", F.coalesce("_slice", F.lit(0)))
        .drop("_hot", "_slice")
    )


def join_users(
    events: DataFrame, per_user: DataFrame, hot: HotKeys | None, how: str = "inner"
) -> DataFrame:
    """Join event rows with per-user rows; a hot user's events stay on many tasks."""
    if hot is None:
        return events.join(per_user, "userid", how)
    return events.join(spread(per_user, hot), ["userid", "slice"], how)
