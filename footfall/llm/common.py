"""What the operators of this folder share: tables, folds, joins by id, components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

#: Ids up to this many (8 bytes each, 8 MB) are broadcast; more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Rows of one Arrow batch: bounds what a Python worker holds at once.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small; a smaller setting stays as it is."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def fold(parts: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def only_ids(rows: DataFrame, ids: DataFrame, on: Sequence[str], anti: bool = False) -> DataFrame:
    """The rows whose key is (or is not) in ``ids``, a stored table of distinct keys.

    Few ids are broadcast behind a count; beyond it both sides are shuffled.
    """
    right = F.broadcast(ids) if ids.count() <= BROADCAST_IDS // len(on) else ids
    return rows.join(right, list(on), "left_anti" if anti else "left_semi")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (u, v): the smallest id reachable.

    Each round takes the smallest label among an id and its neighbours and then the
    label of that label, so paths shrink by half or more; labels are written once a
    round. Nothing but one count per round reaches the driver.
    """
    both = stored(
        links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    )
    labels = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("c")))
    while True:
        near = (
            both.join(labels.select(F.col("u").alias("v"), "c"), "v").groupBy("u").agg(F.min("c").alias("m"))
        )
        lower = labels.join(near, "u").select("u", "c", F.least("c", "m").alias("m"))
        of_label = labels.select(F.col("u").alias("m"), F.col("c").alias("mc"))
        after = stored(
            lower.join(of_label, "m").select("u", F.least("m", "mc").alias("c"), (F.least("m", "mc") != F.col("c")).alias("moved"))
        )
        if after.where("moved").isEmpty():
            return after.select(F.col("u").alias("id"), F.col("c").alias("component"))
        labels = after.select("u", "c")
