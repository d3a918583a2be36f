"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on; sizes stay with the cluster.

    Days are UTC days. Joins of a hot user may be split even when that costs
    one more shuffle. Rows already partitioned by user are joined on (user, day)
    and (user, session) where they are.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineages: the cluster's own, else a fresh local one.

    A cluster names it in ``spark.checkpoint.dir``. Without that setting a local
    session (tests, a laptop) gets a temporary folder; a cluster without it is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current:
        return current
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="footfall-checkpoint-")
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Driver rows as a local relation, whose size the planner knows."""
    fields = spark.createDataFrame([], schema).schema.fields
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    types = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "date": pa.date32(),
             "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    table = pa.table({
        f.name: pa.array(values, types[f.dataType.simpleString()]) for f, values in zip(fields, columns)
    })
    return spark.createDataFrame(table)


def fresh_folder(spark: SparkSession) -> str:
    """A new path of this application in the shared folder."""
    folder = ensure_checkpoint_dir(spark)
    return f"{folder.rstrip('/')}/footfall/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def stored(rows: DataFrame) -> DataFrame:
    """Write ``rows`` once to the shared folder and read them back.

    Cuts the lineage: later jobs neither plan nor recompute what led here, lost
    executors take nothing with them, and scans prune columns as for any table.
    """
    spark = rows.sparkSession
    path = fresh_folder(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def remove_folders(spark: SparkSession, pattern: str, keep: str | None = None) -> None:
    """Delete the folders that ``pattern`` matches, but for the one named ``keep``, in whatever store they are."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(conf)
    for found in fs.globStatus(path) or []:
        if found.getPath().getName() != keep:
            fs.delete(found.getPath(), True)
