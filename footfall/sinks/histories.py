"""Export of sampled user histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.names import HISTORY_FIELDS


def export_histories(rows: DataFrame, path: str) -> None:
    """A folder per user with CSV files, header first, ordered by time.

    Files follow each other in name order; a long history may span several.
    """
    (
        rows.select(*HISTORY_FIELDS, F.col("userid").alias("user"))
        .orderBy("user", "created_at", "activation_time")
        .write.mode("overwrite")
        .partitionBy("user")
        .option("header", True)
        .csv(path)
    )
