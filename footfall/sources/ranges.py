"""Date ranges cut into batches."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.names import DOWNLOAD_BATCH_DAYS
from footfall.session import small_table


def date_batches(ranges: DataFrame, start: str, end: str, days: int = DOWNLOAD_BATCH_DAYS) -> DataFrame:
    """Cut each inclusive range into batches of ``days`` days, the last one clipped."""
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    step = F.make_dt_interval(F.lit(days))
    return (
        ranges.where(first <= last)
        .withColumn("from_date", F.explode(F.sequence(first, last, step)))
        .withColumn("from_date", F.to_date("from_date"))
        .withColumn("to_date", F.least(F.date_add("from_date", days - 1), last))
        .select("from_date", "to_date")
    )


def date_batches_between(spark: SparkSession, start: date, end: date, days: int = DOWNLOAD_BATCH_DAYS) -> DataFrame:
    ranges = small_table(spark, [(start, end)], "start_day date, end_day date")
    return date_batches(ranges, "start_day", "end_day", days)
