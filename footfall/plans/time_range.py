"""Time ranges of the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def between(logs: DataFrame, start, end=None) -> DataFrame:
    """Rows of ``[start, end)``, or from ``start`` on; prunes a log stored by day."""
    rows = logs.where(F.col("created_at") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("created_at") < F.lit(end))
    if "event_date" in logs.columns:
        rows = rows.where(F.col("event_date") >= F.lit(start).cast("date"))
        if end is not None:
            rows = rows.where(F.col("event_date") <= F.lit(end).cast("date"))
    return rows
