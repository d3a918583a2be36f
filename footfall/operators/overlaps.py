"""Overlaps between a cohort, got-value users and experimental sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def users_in_both(users: DataFrame, cohort: DataFrame) -> DataFrame:
    """Distinct users of one table that are in the cohort."""
    return users.select("userid").distinct().join(
        cohort.select("userid").distinct(), "userid", "left_semi"
    )


def experimental_and_got_value(
    experimental: DataFrame, got_value: DataFrame, cohort: DataFrame
) -> DataFrame:
    """Flagged sessions per cohort user that also got the value.

    Every session pairs with every got-value row of the user, so the pair count
    is the product of two counts and no pair is built.
    """
    sessions = experimental.groupBy("userid").agg(F.count("session").alias("sessions"))
    moments = got_value.groupBy("userid").agg(F.count(F.lit(1)).alias("moments"))
    return (
        sessions.join(moments, "userid")
        .join(cohort.select("userid").distinct(), "userid", "left_semi")
        .select("userid", (F.col("sessions") * F.col("moments")).alias("count"))
    )


def got_value_not_experimental(
    experimental: DataFrame, got_value: DataFrame, cohort: DataFrame, null_aware: bool = False
) -> DataFrame:
    """Cohort users that got the value and have no flagged session.

    ``null_aware`` gives SQL's NOT IN: one NULL id among the flagged sessions
    leaves nothing.
    """
    flagged = experimental.select("userid").distinct()
    users = users_in_both(got_value, cohort)
    kept = users.join(flagged, "userid", "left_anti")
    if null_aware:
        nulls = experimental.agg(F.count_if(F.col("userid").isNull())).scalar()
        kept = kept.where(nulls == 0)
    return kept
