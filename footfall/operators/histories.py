"""Sampling users and reading their histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions.scalars import json_text
from footfall.plans.time_range import between


def users_between(logs: DataFrame, start, end) -> DataFrame:
    return between(logs, start, end).select("userid").distinct()


def _lot(seed: int) -> Column:
    """An even number in (0, 1] per seed and user, the same on every run and engine."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("userid"))), 1, 12)
    return (F.conv(digits, 16, 10).cast("bigint") + 1) / F.lit(float(1 << 48))


def sample_users(
    events: DataFrame, size: int, seed: int = 0, by: str = "user", order: Column | None = None
) -> DataFrame:
    """``size`` random users; which ones depends on the seed and the users alone, but for ``by="event"``.

    ``by="user"`` draws distinct users with equal chances. ``by="weight"`` draws distinct
    users without replacement, each as likely as it has events: every user gets an
    exponential waiting time whose rate is its number of events, and the first come out.
    ``by="event"`` draws event rows, so heavy users come up more often and may repeat.
    ``order`` replaces the random order.
    """
    if by == "user":
        rows = events.select("userid").distinct()
        lot = F.md5(F.concat(F.lit(f"{seed}:"), F.col("userid")))
    elif by == "weight":
        rows = events.groupBy("userid").agg(F.count(F.lit(1)).alias("_n"))
        lot = -F.log(_lot(seed)) / F.col("_n")
    elif by == "event":
        rows, lot = events.select("userid"), F.rand(seed)
    else:
        raise ValueError("by must be 'user', 'weight' or 'event'")
    return rows.orderBy(lot if order is None else order, "userid").limit(size).select("userid")


def histories(logs: DataFrame, users: DataFrame) -> DataFrame:
    """Histories of sampled users, in the column order of the export."""
    rows = logs.join(users.select("userid").distinct(), "userid", "left_semi")
    return rows.select(
        "event",
        json_text(F.col("properties"), N.KEY_STRING).alias("string_value"),
        "session", "activation_time", "network", "created_at",
        json_text(F.col("properties"), N.KEY_COUNT).alias("count_value"),
        "userid",
    )
