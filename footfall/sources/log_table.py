"""The stored event log: append, read, and loading landed files by date.

All writers, streams included, partition the log by day and by load. A load has a name
of its own and its folders are replaced as a whole, so a job that failed halfway can be
repeated, and appends, loads and streams may share one log.
"""

from __future__ import annotations

import re
import uuid
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import names as N
from footfall.session import remove_folders, stored
from footfall.sources.json_events import LOG_COLUMNS, lift, mark_rejects, read_lines, split_rejects


def with_event_date(log: DataFrame) -> DataFrame:
    return log.withColumn("event_date", F.to_date("created_at"))


LOG_PARTITIONS = ("event_date", "load")


def write_load(log: DataFrame, path: str, load: str) -> None:
    """Files per day of one load, ordered by user and time, in place of what the load wrote before.

    The range also covers the time, so neither a big day nor a hot user ends up
    in one task, and the files' min/max values prune by user.
    """
    order = [*LOG_PARTITIONS, "userid", "created_at"]
    (
        with_event_date(log).withColumn("load", F.lit(load))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, "activation_time", "event_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LOG_PARTITIONS)
        .parquet(path)
    )


def append_logs(log: DataFrame, path: str) -> None:
    """Append to the log."""
    write_load(log, path, f"append-{uuid.uuid4().hex}")


def replace_days(log: DataFrame, path: str) -> None:
    """Write the days of ``log`` anew, whatever loads they came from.

    The new rows are there before the old ones go; running it again, also after a
    failure in between, leaves the rows of ``log`` alone in these days.
    """
    load = f"days-{uuid.uuid4().hex}"
    log = stored(log)
    write_load(log, path, load)
    for row in with_event_date(log).select(F.col("event_date").cast("string").alias("day")).distinct().collect():
        remove_folders(log.sparkSession, f"{path}/event_date={row['day']}/load=*", keep=f"load={load}")


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """The log with its partition column ``event_date`` for pruning by day."""
    return spark.read.parquet(path).select(*LOG_COLUMNS, "event_date")


MARK = "load int, last_day date, file string"


def _marks(spark: SparkSession, mark_path: str) -> DataFrame:
    """A row per loaded file, with the number of the load and the last day it loaded."""
    try:
        return spark.read.schema(MARK).json(mark_path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MARK)
        raise


def _new_files(spark: SparkSession, source: str, marks: DataFrame) -> list[str]:
    """Names of the landed files no load has read; contents are not touched."""
    landed = spark.read.format("binaryFile").load(source).select(F.col("path").alias("file"))
    return [r.file for r in landed.join(marks.select("file"), "file", "left_anti").orderBy("file").collect()]


def _plain(path: str) -> str:
    """A path whose name is not taken for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def ingest_increment(
    spark: SparkSession,
    source: str,
    log_path: str,
    rejects_path: str,
    mark_path: str,
    today: date | None = None,
    lag_days: int = N.INGEST_LAG_DAYS,
) -> tuple[date | None, date] | None:
    """Load the files that landed since the last load, days up to ``lag_days`` before today.

    Only new files are read; a file must not change once it has landed. Rows of later
    days wait beside the mark, already parsed, until a load reaches their day. A row of
    a day that earlier loads covered is added to that day. Rejects are written by the
    load that reads them, once, since a line without a time belongs to no day.

    Log and rejects are partitioned by the number of the load as well, and replaced for
    that number, so a run that failed halfway can be repeated. The mark comes last; it
    is appended, never rewritten. Returns the first (None: from the beginning) and last
    day that became due, twice the last day for late rows alone, or None when there is
    neither a new file nor a new day.
    """
    today = today or datetime.now(timezone.utc).date()
    end = today - timedelta(days=lag_days)
    marks = _marks(spark, mark_path)
    number, last = marks.agg(F.max("load"), F.max("last_day")).first()
    start = last + timedelta(days=1) if last else None
    files = _new_files(spark, source, marks)
    if start and start > end:
        if not files:
            return None
        start = end = last
    load = (number or 0) + 1
    lines = read_lines(spark, [_plain(f) for f in files]) if files else spark.createDataFrame([], "value string")
    rows, rejects = split_rejects(stored(mark_rejects(lift(lines))))
    if number:
        rows = rows.unionByName(spark.read.parquet(f"{mark_path}/_waiting/load={number}"))
    due = F.to_date("created_at") <= F.lit(end)
    write_load(rows.where(due), log_path, f"ingest-{load}")
    (
        rejects.withColumn("loaded_to", F.lit(end)).withColumn("load", F.lit(f"ingest-{load}"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load")
        .json(rejects_path)
    )
    rows.where(~due).write.mode("overwrite").parquet(f"{mark_path}/_waiting/load={load}")
    # in one file, so that it is there as a whole or not at all
    mark = spark.createDataFrame([(load, end, f) for f in files or [None]], MARK).coalesce(1)
    mark.write.mode("append").json(mark_path)
    # a load whose mark is there is never repeated, so what waited before it is done with
    remove_folders(spark, f"{mark_path}/_waiting/load=*", keep=f"load={load}")
    return start, end
