"""Reports given as SQL text with a cohort view and date parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_template(spark: SparkSession, sql: str, view: str, **parameters) -> DataFrame:
    """Run ``sql`` with ``IDENTIFIER(:view)`` and other named parameters bound."""
    return spark.sql(sql, args={"view": view, **parameters})
