"""Session times: first and last event per (user, session)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions.scalars import micros_between


def session_bounds(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First and last event time per session, without the map-end event."""
    return (
        events.where(F.col("event") != "MapModeEnd")
        .groupBy("userid", "session", *by)
        .agg(F.min("created_at").alias("started"), F.max("created_at").alias("ended"))
    )


def kept_sessions(bounds: DataFrame, limit_seconds: int = N.SESSION_LIMIT_SECONDS) -> DataFrame:
    """Sessions shorter than the limit, with their duration in microseconds."""
    return bounds.withColumn(
        "duration_us", micros_between(F.col("ended"), F.col("started"))
    ).where(F.col("duration_us") < limit_seconds * 1_000_000)


def user_days(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per user and active day, with the day's number in ``active_day``.

    Windows run over these rows, at most one per calendar day and user.
    """
    days = (
        sessions.groupBy("userid", *by, F.to_date("started").alias("day"))
        .agg(
            F.sum("duration_us").alias("total_us"),
            F.count(F.lit(1)).alias("sessions_per_day"),
        )
        .withColumn("avg_us", F.round(F.col("total_us") / F.col("sessions_per_day")).cast("bigint"))
    )
    user = Window.partitionBy("userid", *by)
    return days.withColumn("active_day", F.dense_rank().over(user.orderBy("day"))).withColumn(
        "first_day", F.min("day").over(user)
    )


def session_times(events: DataFrame, limit_seconds: int = N.SESSION_LIMIT_SECONDS) -> DataFrame:
    """Kept sessions with start, duration and active-day number."""
    kept = kept_sessions(session_bounds(events), limit_seconds)
    days = user_days(kept).select("userid", "day", "active_day")
    return (
        kept.withColumn("day", F.to_date("started"))
        .join(days, ["userid", "day"])
        .select("userid", "session", F.col("started").alias("session_started"), "duration_us", "active_day")
    )
