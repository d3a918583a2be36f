"""Retention reports per active day and per day since the first one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions.aggregates import rising
from footfall.functions.quantiles import quantiles
from footfall.operators.offline import offline_runs
from footfall.operators.sessions import kept_sessions, session_bounds, user_days

METRICS = {
    "sessions_per_day": "sessions_per_day",
    "avg_usage_per_day": "avg_us",
    "total_usage_per_day": "total_us",
}


def usage_values(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many user-days have each value of each metric, per active day."""
    group = [*by, "active_day"]
    values = days.select(
        *group,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(metric).alias("metric"), F.col(source).alias("value"))
                    for metric, source in METRICS.items()
                ]
            )
        ),
    )
    return values.groupBy(*group, "metric", "value").agg(F.count(F.lit(1)).alias("weight"))


def usage_boxplots(values: DataFrame, by: Sequence[str] = (), rule: str = "disc") -> DataFrame:
    """Boxplots of sessions, average and total seconds per active day."""
    group = [*by, "active_day"]
    # one user-day gives one value of every metric, so their number is that of users
    boxes = quantiles(
        values, [*group, "metric"], "value", rule=rule, total="unique_users", weight="weight"
    )

    def box(metric: str):
        return F.max(F.when(F.col("metric") == metric, F.col("boxplot")))

    def seconds(column):
        return F.transform(column, lambda us: us / F.lit(1e6))

    return boxes.groupBy(*group).agg(
        box("sessions_per_day").alias("sessions_per_day_boxplot"),
        seconds(box("avg_usage_per_day")).alias("avg_usage_per_day_boxplot"),
        seconds(box("total_usage_per_day")).alias("total_usage_per_day_boxplot"),
        F.max("unique_users").alias("unique_users"),
    )


def return_days(
    days: DataFrame,
    runs: DataFrame,
    by: Sequence[str] = (),
    min_offline: int = N.DAY_OFFLINE_MIN_EVENTS,
) -> DataFrame:
    """One row per user and active day: days since the first one, offline or not."""
    offline = (
        runs.where(F.col("offline_times") >= min_offline)
        .select("userid", *by, F.to_date("started").alias("day"), F.lit(True).alias("went_offline"))
        .distinct()
    )
    return days.join(offline, ["userid", *by, "day"], "left").select(
        "userid", *by, F.datediff("day", "first_day").alias("came_back_day"), "went_offline"
    )


def return_values(returns: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return returns.groupBy(*by, "came_back_day").agg(
        F.count(F.lit(1)).alias("weight"), F.count("went_offline").alias("offline")
    )


def returning_users(values: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Users back per day since their first, and how many went offline that day."""
    return values.groupBy(*by, "came_back_day").agg(
        F.sum("weight").alias("retention_count"), F.sum("offline").alias("went_offline")
    )


def retention_boxplots_report(
    events: DataFrame, limit_seconds: int = N.SESSION_LIMIT_SECONDS, rule: str = "disc"
) -> DataFrame:
    days = user_days(kept_sessions(session_bounds(events), limit_seconds))
    return usage_boxplots(usage_values(days), rule=rule).orderBy(rising("active_day"))


def retention_days_report(
    events: DataFrame,
    limit_seconds: int = N.SESSION_LIMIT_SECONDS,
    excluded: Sequence[str] = N.RETENTION_RUN_EXCLUDED,
    sliced: bool = False,
) -> DataFrame:
    days = user_days(kept_sessions(session_bounds(events), limit_seconds))
    returns = return_days(days, offline_runs(events, excluded, sliced))
    return returning_users(return_values(returns)).orderBy(rising("came_back_day"))
