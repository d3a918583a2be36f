"""How often things happen: add sources, events, map use."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions.aggregates import falling, rising
from footfall.functions.quantiles import disc_rank, quantiles
from footfall.functions.scalars import contains_london, json_text, round_half_up, starts_london

ADD_EVENT = "ItineraryAdd2"


def add_sources_per_user(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return (
        events.where(F.col("event") == ADD_EVENT)
        .groupBy("userid", "it_add_from", *by)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def add_source_values(per_user: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return per_user.groupBy(*by, "it_add_from").agg(F.sum("n").alias("weight"))


def add_source_counts(values: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds by source button; adds without a source form a NULL group."""
    return values.groupBy(*by, "it_add_from").agg(F.sum("weight").alias("num_of_pluses"))


def add_source_report(events: DataFrame) -> DataFrame:
    return (
        events.where(F.col("event") == ADD_EVENT)
        .groupBy("it_add_from")
        .agg(F.count(F.lit(1)).alias("num_of_pluses"))
        .orderBy(rising("num_of_pluses"), rising("it_add_from"))
    )


def add_source_share(logs: DataFrame) -> DataFrame:
    """Percentage per add source; the NULL group counts nothing and shows 0."""
    source = json_text(F.col("properties"), N.KEY_ADD_SOURCE).alias("addfrom")
    counts = (
        logs.where(F.col("event") == ADD_EVENT)
        .select(source)
        .groupBy("addfrom")
        .agg(F.count("addfrom").alias("counts"))
    )
    total = counts.agg(F.sum("counts")).scalar()
    share = F.try_divide(F.col("counts").cast("decimal(20,0)") * 100, total)
    return counts.select(
        "addfrom", F.round(share, 2).cast("decimal(20,2)").alias("percentage")
    ).orderBy(rising("addfrom"))


def events_per_user(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return events.groupBy("userid", "event", *by).agg(F.count("event").alias("counts"))


def event_values(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many users have each count of each event."""
    return counts.groupBy(*by, "event", "counts").agg(F.count(F.lit(1)).alias("weight"))


def event_distribution(values: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Median and mean number per user of every event.

    Few distinct counts exist per event (see ``count_quantiles``).
    """
    group = Window.partitionBy(*by, "event")
    users = values.groupBy(*by, "event", "counts").agg(F.sum("weight").alias("users"))
    ranked = users.withColumn(
        "upto", F.sum("users").over(group.orderBy("counts"))
    ).withColumn("rank", disc_rank(F.lit(0.5), F.sum("users").over(group)))
    total = F.sum(F.col("counts") * F.col("users")).cast("decimal(38,12)")
    return ranked.groupBy(*by, "event").agg(
        F.min(F.when(F.col("upto") >= F.col("rank"), F.col("counts"))).alias("median"),
        round_half_up(total / F.sum("users"), 1).cast("double").alias("average"),
    )


def event_distribution_report(events: DataFrame) -> DataFrame:
    out = event_distribution(event_values(events_per_user(events)))
    return out.orderBy(falling("median"), rising("event"))


# -- map use ----------------------------------------------------------------


def details_map_ratio(
    logs: DataFrame,
    first_cities: DataFrame,
    experimental: DataFrame,
    in_london: Callable[[Column], Column] = starts_london,
) -> DataFrame:
    """Per London user: map openings per details view, without flagged sessions.

    Counts are added up per session before any join.
    """
    per_session = (
        logs.where(F.col("event").isin("DetailsChecked", "DetailsMapOpen"))
        .groupBy("userid", "session")
        .agg(
            F.count_if(F.col("event") == "DetailsMapOpen").alias("maps"),
            F.count_if(F.col("event") == "DetailsChecked").alias("checks"),
        )
    )
    londoners = first_cities.where(in_london(F.col("first_city"))).select("userid")
    return (
        per_session.join(experimental, ["userid", "session"], "left_anti")
        .groupBy("userid")
        .agg(F.sum("maps").alias("maps"), F.sum("checks").alias("checks"))
        .where(F.col("checks") > 0)
        .join(londoners, "userid", "left_semi")
        .select("userid", (F.col("maps").cast("double") / F.col("checks").cast("double")).alias("ratio"))
    )


def map_confusion_report(logs: DataFrame, first_cities: DataFrame, experimental: DataFrame) -> DataFrame:
    ratios = details_map_ratio(logs, first_cities, experimental).withColumn("all", F.lit(1))
    return quantiles(ratios, ["all"], "ratio", rule="index", name="ratio").drop("all")


def map_use(
    logs: DataFrame,
    opened: str = "MapModeStart",
    transit: str = "TransitModeFromItinerary",
    details: str = "DetailsMapOpen",
) -> DataFrame:
    """Per user: map views of their own, via transit and via details."""
    counts = logs.groupBy("userid").agg(
        F.count_if(F.col("event") == opened).alias("opened"),
        F.count_if(F.col("event") == transit).alias("transitmap"),
        F.count_if(F.col("event") == details).alias("detailsmap"),
    )
    return counts.where(F.col("opened") >= F.col("transitmap")).select(
        "userid", (F.col("opened") - F.col("transitmap")).alias("mapview"), "transitmap", "detailsmap"
    )


def map_viewers(
    use: DataFrame,
    first_cities: DataFrame,
    in_london: Callable[[Column], Column] = contains_london,
) -> DataFrame:
    londoners = first_cities.where(in_london(F.col("first_city"))).select("userid")
    return use.where(F.col("mapview") > 0).join(londoners, "userid", "left_semi").select("userid")


def map_viewers_report(use: DataFrame, first_cities: DataFrame) -> DataFrame:
    return map_viewers(use, first_cities).agg(F.count(F.lit(1)).alias("count"))


def map_viewers_who(
    logs: DataFrame, use: DataFrame, first_cities: DataFrame, event: str = "POIBarSwipe"
) -> DataFrame:
    """Map viewers in London who used a control."""
    did = logs.where(F.col("event") == event).select("userid").distinct()
    return did.join(map_viewers(use, first_cities), "userid", "left_semi")


def map_flag_combinations(use: DataFrame) -> DataFrame:
    """Users per combination of the three map flags, with percentage."""
    flags = use.select(
        (F.col("mapview") > 0).alias("mapview"),
        (F.col("transitmap") > 0).alias("transitmap"),
        (F.col("detailsmap") > 0).alias("detailsmap"),
    )
    cells = flags.groupBy("mapview", "transitmap", "detailsmap").agg(F.count(F.lit(1)).alias("users"))
    total = cells.agg(F.sum("users")).scalar()
    share = F.col("users").cast("decimal(20,0)") * 100 / total
    return cells.withColumn("pct", F.round(share, 2).cast("decimal(20,2)"))
