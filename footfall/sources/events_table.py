"""Adapter from a plain ``events`` table to the app's typed event log.

The table has ``event_id, ts, user_id, event_type, value, props`` with a small
number ``k`` in ``props``. City, network, variant and the other app properties
are derived from ``k`` so that every operator has real rows to work on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import names as N
from footfall.plans.scan import Previous, RunningSum, scan
from footfall.plans.skew import MAX_ROWS, HotKeys, add_slice, find_hot
from footfall.session import small_table

SESSION_GAP_SECONDS = 21_600
#: kept-session limit for these sparse histories
SESSION_LIMIT_SECONDS = 21_600


def _event(first: Column) -> Column:
    kind, k = F.col("event_type"), F.col("k")
    return (
        F.when(first, "AppStartup")
        .when(kind == "signup", F.when(k < 50, "MapModeEnd").otherwise("ButtonPressToItinerary"))
        .when(kind == "view", F.when(k < 50, "MapIteraction").otherwise("DetailsChecked"))
        .when(kind == "click", F.when(k < 70, "ItineraryAdd").otherwise("ItineraryAdd2"))
        .when(kind == "purchase", "TransitListInfoOpen")
        .when(kind == "error", F.when(k < 50, "ItineraryRemove").otherwise("DetailsMapOpen"))
    )


def _city(k: Column) -> Column:
    return (
        F.when(k < 40, N.LONDON).when(k < 70, "Paris")
        .when(k < 80, N.UNKNOWN).when(k < 90, N.NO_LOCATION)
    )


def read_events_table(
    spark: SparkSession, folder: str, max_rows: int = MAX_ROWS
) -> tuple[DataFrame, HotKeys | None]:
    """Typed event log of ``{folder}/events.parquet`` and its hot users."""
    raw = spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type", "props"
    )
    hot = find_hot(raw, "user_id", "ts", max_rows)
    return to_log(raw, hot), hot


def to_log(raw: DataFrame, hot: HotKeys | None) -> DataFrame:
    rows = raw.select(
        "event_id",
        F.col("user_id").cast("string").alias("userid"),
        "event_type",
        F.col("ts").cast("timestamp").alias("created_at"),
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("int").alias("k"),
        (
            F.datediff("ts", F.lit("2000-01-01")) * 86400 + F.hour("ts") * 3600
            + F.minute("ts") * 60 + F.second("ts")
        ).alias("sec"),
    )
    rows = add_slice(rows, hot)
    order = ["sec", "event_id"]
    sliced = hot is not None
    # the first row's time rides along, so the start needs no second pass
    rows = scan(rows, ["userid"], order, {"before": Previous(F.col("sec"))}, sliced)
    gap = F.coalesce(F.col("sec") - F.col("before") > SESSION_GAP_SECONDS, F.lit(False))
    first = F.col("before").isNull()
    rows = scan(
        rows, ["userid"], order,
        {
            "gaps": RunningSum(F.when(gap, 1).otherwise(0)),
            "start": RunningSum(F.when(first, F.col("sec")).otherwise(0)),
        },
        sliced,
    )
    k = F.col("k")
    return rows.select(
        "userid",
        _event(first).alias("event"),
        "created_at",
        (F.col("gaps") + 1).cast("int").alias("session"),
        (k % 2 == 1).alias("network"),
        (F.col("sec") - F.col("start")).cast("int").alias("activation_time"),
        _city(k).alias("city"),
        # to_json leaves NULL fields out
        F.to_json(
            F.struct(
                F.unix_seconds("created_at").alias(N.KEY_TIME),
                F.col("userid").alias(N.KEY_USER),
                (F.col("gaps") + 1).alias(N.KEY_SESSION),
                (F.col("sec") - F.col("start")).alias(N.KEY_ACTIVATION),
                (k % 2 == 1).alias(N.KEY_NETWORK),
                _city(k).alias(N.KEY_CITY),
                (k % 12).cast("string").alias(N.KEY_COUNT),
                (F.col("userid").cast("bigint") % 2).cast("string").alias(N.KEY_VARIANT),
                F.when(k % 4 < 3, (k % 4).cast("string")).alias(N.KEY_ADD_SOURCE),
                F.when(k % 3 < 2, (k % 3).cast("string")).alias(N.KEY_BRANCH),
            )
        ).alias("properties"),
        "event_id",
        "slice",
    )


def gazetteer(spark: SparkSession) -> DataFrame:
    """Regions of the two cities the adapter uses."""
    return small_table(spark, [("London", "London"), ("Paris", "ROW")], "city string, region string")
