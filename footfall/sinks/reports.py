"""Report results as nested JSON and as CSV sections.

Input is the long result of ``plans.matrix``: one row per report row with the
values as a JSON object in ``result``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.scalars import last_day_label
from footfall.plans.cohorts import COHORTS
from footfall.session import stored

MAX_REPORTS = 1000
_ROWS = (
    "date_start date, usergroup string, date_end date, categories "
    "map<string, array<struct<title: string, fields: array<string>, result: array<string>>>>"
)


def write_report_json(rows: DataFrame, path: str, cells: DataFrame | None = None) -> None:
    """One document per start, cohort and end, with the reports by category.

    ``cells`` lists reports that shall appear even when they have no rows.

    ``{"date_start", "usergroup", "date_end", "categories": {id: [{title, fields, result}]}}``
    """
    if cells is not None:
        rows = rows.unionByName(cells, allowMissingColumns=True)
    line = F.when(F.col("result").isNotNull(), F.struct("row", "result"))
    # texts are put together, so numbers stay as the reports wrote them
    head = F.to_json(F.struct("title", "fields"))
    reports = rows.groupBy("date_start", "usergroup", "date_end", "category_id", "title", "fields").agg(
        F.array_sort(F.collect_list(line)).alias("rows")
    ).withColumn(
        "report",
        F.concat(head.substr(F.lit(1), F.length(head) - 1), F.lit(',"result":['),
                 F.concat_ws(",", "rows.result"), F.lit("]}")),
    )
    categories = reports.groupBy("date_start", "usergroup", "date_end", "category_id").agg(
        F.concat(_quoted(F.col("category_id")), F.lit(":["),
                 F.concat_ws(",", F.array_sort(F.collect_list("report"))), F.lit("]")).alias("category")
    )
    documents = categories.groupBy("date_start", "usergroup", "date_end").agg(
        F.concat_ws(",", F.array_sort(F.collect_list("category"))).alias("categories")
    )
    cell = F.to_json(F.struct("date_start", "usergroup", "date_end"))
    documents.select(
        F.concat(cell.substr(F.lit(1), F.length(cell) - 1), F.lit(',"categories":{'),
                 F.col("categories"), F.lit("}}")).alias("value")
    ).write.mode("overwrite").text(path)


def _quoted(text: Column) -> Column:
    """Text as a JSON string."""
    listed = F.to_json(F.array(text))
    return listed.substr(F.lit(2), F.length(listed) - 2)


def read_report_json(spark: SparkSession, path: str) -> DataFrame:
    """Back from the documents to the long result."""
    return (
        spark.read.schema(_ROWS).json(path)
        .select("date_start", "date_end", "usergroup", F.explode("categories").alias("category_id", "reports"))
        .select("date_start", "date_end", "usergroup", "category_id", F.inline("reports"))
        .select("date_start", "date_end", "usergroup", "category_id", "title", "fields",
                F.posexplode("result").alias("row", "result"))
        .withColumn("row", F.col("row") + 1)
    )


def folder_name(title: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", title.lower()).strip("_")


def write_report_csv(rows: DataFrame, path: str) -> dict[str, str]:
    """CSV files with header per report, start, window and cohort.

    Windows are labelled by their last day. Returns the folder of each title.
    Only the list of reports, which is small, is brought to the driver.
    """
    rows = stored(rows)  # small, and read once per report
    listed = rows.select("title", "fields").distinct().limit(MAX_REPORTS + 1).collect()
    if len(listed) > MAX_REPORTS:
        raise ValueError(f"more than {MAX_REPORTS} reports")
    describe = F.create_map(*[
        F.lit(text) for name, spec in COHORTS.items() for text in (name, spec.description)
    ])
    folders, cell = {}, ["date_start", "date_last", "usergroup"]
    for title, fields in sorted((r["title"], tuple(r["fields"])) for r in listed):
        folder = folders[title] = f"{path}/{folder_name(title)}"
        values = F.from_json("result", "map<string,string>")
        (
            rows.where(F.col("title") == title)
            .withColumn("_values", values)
            .select(
                "date_start",
                last_day_label(F.col("date_end")).alias("date_last"),
                "usergroup",
                F.coalesce(describe[F.col("usergroup")], F.col("usergroup")).alias("Group"),
                F.lit(title).alias("Query"),
                *[F.col("_values")[f].alias(f) for f in fields],
                "row",
            )
            .repartition(*cell)
            .sortWithinPartitions(*cell, "row")
            .drop("row")
            .write.mode("overwrite")
            .partitionBy(*cell)
            .option("header", True)
            .csv(folder)
        )
    return folders


def report_json_to_csv(spark: SparkSession, json_path: str, csv_path: str) -> dict[str, str]:
    return write_report_csv(read_report_json(spark, json_path), csv_path)
