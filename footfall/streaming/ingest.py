"""Incremental ingest as a stream, and day counts with an allowance for late data."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from footfall.sources.json_events import lift, mark_rejects, split_rejects
from footfall.sources.log_table import read_logs, write_load

LATE = "2 days"


def read_line_stream(spark: SparkSession, source: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(source)


def _stream_name(checkpoint: str) -> str:
    """Tells the loads of streams into one log apart."""
    return "stream-" + hashlib.md5(checkpoint.encode()).hexdigest()[:8]


def _load_batches(
    lines: DataFrame, rejects_path: str, checkpoint: str, write_log: Callable[[DataFrame, str, int], None]
) -> StreamingQuery:
    name = _stream_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        load = f"{name}-{batch_id}"
        marked = mark_rejects(lift(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            log, rejects = split_rejects(marked)
            write_log(log, load, batch_id)
            (
                rejects.withColumn("load", F.lit(load))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("load").json(rejects_path)
            )
        finally:
            marked.unpersist()

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(
    lines: DataFrame, log_path: str, rejects_path: str, checkpoint: str
) -> StreamingQuery:
    """Load everything that has landed and stop.

    A micro batch is a load of the log (see ``log_table``) and replaced as a whole,
    so a batch that is run again after a failure writes the same files.
    """
    return _load_batches(lines, rejects_path, checkpoint, lambda log, load, _: write_load(log, log_path, load))


BOUNDARY = "batch int, closed_to date"


def _closed_to(spark: SparkSession, path: str, batch_id: int):
    """First day that was still open when the batch began; None: all were."""
    try:
        return spark.read.schema(BOUNDARY).json(path).where(F.col("batch") < batch_id).agg(F.max("closed_to")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def closing_stream(
    lines: DataFrame, log_path: str, rejects_path: str, late_path: str, counts_path: str, checkpoint: str, late_days: int = 2
) -> StreamingQuery:
    """``ingest_stream`` that closes days: counts of a closed day are final.

    After each micro batch the days that ended ``late_days`` days or more before the
    latest event so far are closed and counted by day and event (``counts_path``). Rows
    of days that were closed before their batch go to ``late_path`` instead of the log.
    So closed days, open days and late rows add up to what came in. Every output of a
    batch is replaced as a whole when the batch is run again.
    """
    boundary_path = f"{counts_path}/_boundary"

    def write(log: DataFrame, load: str, batch_id: int) -> None:
        spark = log.sparkSession
        before = _closed_to(spark, boundary_path, batch_id)
        is_late = F.lit(False) if before is None else F.to_date("created_at") < F.lit(before)
        write_load(log.where(~is_late), log_path, load)
        write_load(log.where(is_late), late_path, load)
        last = log.agg(F.date_sub(F.to_date(F.max("created_at")), late_days)).first()[0]
        after = before if last is None else last if before is None else max(before, last)
        if after is None:
            return
        due = read_logs(spark, log_path).where(F.col("event_date") < F.lit(after))
        if before is not None:
            due = due.where(F.col("event_date") >= F.lit(before))
        (
            due.groupBy("event_date", "event").agg(F.count(F.lit(1)).alias("events"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date").json(f"{counts_path}/days")
        )
        mark = spark.createDataFrame([(batch_id, after)], BOUNDARY).coalesce(1)
        mark.write.mode("overwrite").json(f"{boundary_path}/of={batch_id}")

    return _load_batches(lines, rejects_path, checkpoint, write)


def read_closed_days(spark: SparkSession, counts_path: str) -> DataFrame:
    """Final counts: day, event, events."""
    schema = "event string, events bigint, event_date date"
    return spark.read.schema(schema).json(f"{counts_path}/days").select(F.col("event_date").alias("day"), "event", "events")


def closed_day_counts(events: DataFrame, late: str = LATE) -> DataFrame:
    """Events per day and name, given out once no more late data is waited for."""
    return (
        events.withWatermark("created_at", late)
        .groupBy(F.window("created_at", "1 day").alias("day"), "event")
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.to_date("day.start").alias("day"), "event", "events")
    )
