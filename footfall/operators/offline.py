"""Runs of consecutive offline events (gaps and islands)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions.scalars import is_offline
from footfall.plans.scan import Previous, RunningSum, scan

ORDER = ("created_at", "activation_time", "event_id")


def offline_rows(
    events: DataFrame,
    excluded: Sequence[str] = N.RETENTION_RUN_EXCLUDED,
    sliced: bool = False,
) -> DataFrame:
    """Offline events with the number of their run within the user.

    Excluded events are taken out first, so they do not end a run. Any event
    that is not offline, also one with a NULL network, does.
    """
    rows = events.where(~F.col("event").isin(*excluded))
    rows = scan(rows, ["userid"], ORDER, {"_before": Previous(F.col("network"))}, sliced)
    starts = is_offline(F.col("network")) & ~is_offline(F.col("_before"))
    rows = scan(rows, ["userid"], ORDER, {"run": RunningSum(F.when(starts, 1).otherwise(0))}, sliced)
    return rows.where(is_offline(F.col("network"))).drop("_before")


def offline_runs(
    events: DataFrame,
    excluded: Sequence[str] = N.RETENTION_RUN_EXCLUDED,
    sliced: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per run: its start and number of events."""
    return (
        offline_rows(events, excluded, sliced)
        .groupBy("userid", "run", *by)
        .agg(F.min("created_at").alias("started"), F.count(F.lit(1)).alias("offline_times"))
    )


def offline_run_days(runs: DataFrame) -> DataFrame:
    """Start day and size of every run."""
    return runs.select(
        "userid", F.to_date("started").alias("offline_moment"), "offline_times"
    )


def offline_totals(
    events: DataFrame, excluded: Sequence[str] = N.RETENTION_RUN_EXCLUDED
) -> DataFrame:
    """All offline events of a user as one group: first day and number."""
    return (
        events.where(~F.col("event").isin(*excluded) & is_offline(F.col("network")))
        .groupBy("userid")
        .agg(
            F.to_date(F.min("created_at")).alias("offline_moment"),
            F.count(F.lit(1)).alias("offline_times"),
        )
    )
