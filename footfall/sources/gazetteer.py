"""City to region table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """``city, region`` from CSV with header or Parquet, one row per city.

    No broadcast is forced: Spark broadcasts the table when its size allows.
    """
    if path.rstrip("/").endswith(".csv"):
        rows = spark.read.schema("city string, region string").option("header", True).csv(path)
    else:
        rows = spark.read.parquet(path)
    return rows.where(F.col("city").isNotNull()).groupBy("city").agg(F.min("region").alias("region"))
