"""Derived tables that are replaced as a whole."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.scalars import known_city
from footfall.operators.facts import first_cities, first_time_users
from footfall.session import stored

#: order of a stored cohort
COHORT_ORDER = ("userid", "created_at", "activation_time")


def write_experimental_sessions(flagged: DataFrame, path: str) -> None:
    """One row per user and flagged session.

    ``flagged`` has a ``session`` column or an array column ``flagged``.
    """
    rows = flagged
    if "flagged" in flagged.columns:
        rows = flagged.select("userid", F.explode(F.col("flagged").cast("array<int>")).alias("session"))
    rows.select("userid", "session").distinct().write.mode("overwrite").parquet(path)


def write_got_value(hits: DataFrame, path: str) -> None:
    """Users with a got-value moment; rows without one are left out."""
    (
        hits.where(F.col("created_at").isNotNull())
        .select("userid", "created_at", "session", "activation_time", "city")
        .write.mode("overwrite")
        .parquet(path)
    )


def refresh_facts(logs: DataFrame, folder: str) -> None:
    """Rebuild first joins and first cities after an ingest."""
    first_time_users(logs).write.mode("overwrite").parquet(f"{folder}/first_time_users")
    first_cities(logs).write.mode("overwrite").parquet(f"{folder}/first_cities")


def read_facts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return (
        spark.read.parquet(f"{folder}/first_time_users"),
        spark.read.parquet(f"{folder}/first_cities"),
    )


#: Files of users that a merge rewrites one by one.
BUCKETS = 64


def _bucket() -> Column:
    return F.pmod(F.xxhash64("userid"), F.lit(BUCKETS)).cast("int")


def _earliest(rows: DataFrame) -> DataFrame:
    """One row per user: the least join time and the first known city with its place in the history."""
    return rows.groupBy("userid", "bucket").agg(
        F.min("first_join").alias("first_join"), F.min("first_seen").alias("first_seen")
    )


def merge_facts(new_logs: DataFrame, folder: str) -> None:
    """Bring stored facts up to date with a load, without the log of earlier loads.

    Both facts are least values, so those of the load (partly combined before the
    shuffle) and the stored ones merge to those of both. Only the buckets that hold a
    user of the load are read and written anew. Loads may come in any order and a load
    that failed halfway, or came twice, may be merged again.
    """
    spark = new_logs.sparkSession
    join = F.when((F.col("event") == "AppStartup") & (F.col("session") == 1), F.col("created_at"))
    place = F.struct("created_at", "activation_time", "event_id", "city")
    found = new_logs.select(
        "userid", _bucket().alias("bucket"), join.alias("first_join"), F.when(known_city(F.col("city")), place).alias("first_seen")
    )
    fresh = stored(_earliest(found.where("first_join is not null or first_seen is not null")))
    path = f"{folder}/facts"
    try:
        old = spark.read.schema(fresh.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        old = fresh.limit(0)
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most BUCKETS numbers
    merged = stored(_earliest(fresh.unionByName(old.where(F.col("bucket").isin(touched)))))
    (
        merged.repartition("bucket").sortWithinPartitions("bucket", "userid")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    )


def read_merged_facts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """First joins and first cities, as ``read_facts`` gives them."""
    rows = spark.read.parquet(f"{folder}/facts")
    return (
        rows.where("first_join is not null").select("userid", "first_join"),
        rows.where("first_seen is not null").select("userid", F.col("first_seen.city").alias("first_city")),
    )


def save_cohort(events: DataFrame, path: str) -> None:
    """Store a cohort sorted by user and time.

    The sort ranges over all three columns, so a hot user spans several tasks.
    """
    events.orderBy(*COHORT_ORDER).write.mode("overwrite").parquet(path)
