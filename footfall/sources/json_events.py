"""Raw app events: JSON lines to the typed event log.

Each line is parsed twice, once for the event and its properties text and once
for the properties as a map of texts. The map tells a missing key from an
explicit null, which the defaults below depend on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions.scalars import epoch_to_timestamp, whole_number, widen_london

LINE = "event string, properties string"
LOG_COLUMNS = (
    "userid", "event", "created_at", "session", "network", "activation_time", "city",
    "properties", "event_id",
)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of all files of a glob."""
    return spark.read.text(path if isinstance(path, str) else list(path))


def lift(lines: DataFrame) -> DataFrame:
    """Typed columns of each line, with the raw ``value`` kept for rejects.

    ``event_id`` is a hash of the line: the last tie-break of every order.
    """
    # generators keep the parsers in place: a filter pushed below a plain
    # projection would repeat them for every condition
    parsed = lines.select(
        "value", F.inline(F.array(F.from_json("value", LINE)))
    ).select(
        "value", "event", "properties",
        F.explode(F.array(F.from_json("properties", "map<string,string>"))).alias("p"),
    )

    def text(key: str) -> Column:
        return F.col("p")[key]

    def given(key: str, default: Column) -> Column:
        """Value of a key; the default only when the key is missing."""
        return F.when(F.map_contains_key("p", key), text(key)).otherwise(default)

    return parsed.select(
        text(N.KEY_USER).alias("userid"),
        "event",
        epoch_to_timestamp(text(N.KEY_TIME).try_cast("double")).alias("created_at"),
        whole_number(text(N.KEY_SESSION)).alias("session"),
        given(N.KEY_NETWORK, F.lit("true")).try_cast("boolean").alias("network"),
        whole_number(text(N.KEY_ACTIVATION)).alias("activation_time"),
        widen_london(
            text(N.KEY_LATITUDE), text(N.KEY_LONGITUDE), given(N.KEY_CITY, F.lit(N.NO_LOCATION))
        ).alias("city"),
        "properties",
        F.xxhash64("value").alias("event_id"),
        "value",
    )


def mark_rejects(lifted: DataFrame) -> DataFrame:
    """Add what a row lacks as ``reason``; only incomplete rows keep their raw line."""
    required = ("event", "created_at", "userid", "session", "activation_time")
    reason = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return lifted.withColumn("reason", reason).withColumn(
        "value", F.when(F.col("reason") != "", F.col("value"))
    )


def split_rejects(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Complete rows, and the lines that lack something required with the reason."""
    good = marked.where(F.col("reason") == "").select(*LOG_COLUMNS)
    bad = marked.where(F.col("reason") != "").select("value", "reason")
    return good, bad


def normalize_events(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(log, rejects)`` of raw lines.

    Whoever uses both should keep ``mark_rejects(lift(lines))`` in between, or
    the lines are parsed twice.
    """
    return split_rejects(mark_rejects(lift(lines)))
