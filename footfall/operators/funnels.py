"""Counting and funnel reports.

All of them read the same per-user table (``user_facts``: one map-side combined
aggregation) or the first ``k`` adds per user (``first_times``: only ``k`` rows
per user and task are shuffled). Both can be combined over stretches of time,
which the report matrix uses.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions.quantiles import count_quantiles
from footfall.functions.scalars import is_offline, is_online, round_half_up


@dataclass(frozen=True)
class FunnelSteps:
    """Event names of the ordered funnel: adds and a view, then a final event."""

    add: str = "ItineraryAdd"
    view: str = "ButtonPressToItinerary"
    final: str = "TransitListInfoOpen"
    adds: int = 2


def user_facts(events: DataFrame, by: Sequence[str] = (), steps: FunnelSteps = FunnelSteps()) -> DataFrame:
    """One row per user (and ``by``) with everything the counting reports need."""
    event, at = F.col("event"), F.col("activation_time")
    return events.groupBy("userid", *by).agg(
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
        F.count_if(~event.isin(*N.IDLE_EVENTS)).alias("actions"),
        F.count_if(event.isin(*N.ACTIVATION_EVENTS)).alias("activations"),
        F.min(F.when(event == steps.view, at)).alias("first_view"),
        F.max(F.when(event == steps.final, at)).alias("last_final"),
        F.min(F.when((event == "MapIteraction") & is_offline(F.col("network")), at)).alias("offline_map"),
        F.max(F.when(is_online(F.col("network")), at)).alias("last_online"),
    )


#: how two stretches of ``user_facts`` combine
USER_FACTS_MERGE = {
    "first_at": F.min, "last_at": F.max, "actions": F.sum, "activations": F.sum,
    "first_view": F.min, "last_final": F.max, "offline_map": F.min, "last_online": F.max,
}


def first_times(events: DataFrame, event: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` earliest activation times of an event per user, ties kept apart."""
    return lowest_times(
        events.where(F.col("event") == event).select("userid", *by, "activation_time"), k, by
    )


def lowest_times(times: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    order = Window.partitionBy("userid", *by).orderBy(F.col("activation_time").asc_nulls_last())
    return times.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def kth_time(times: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Time of the ``k``-th occurrence, for users who have one."""
    return times.where((F.col("place") == k) & F.col("activation_time").isNotNull()).select(
        "userid", *by, F.col("activation_time").alias("kth_time")
    )


# -- totals over user_facts ---------------------------------------------------


@dataclass(frozen=True)
class Total:
    """A named aggregate and how its partial results merge."""

    name: str
    column: Column
    merge: Callable[[str], Column] = F.sum


def count_users() -> list[Total]:
    return [Total("total_count", F.count("userid"))]


def date_range() -> list[Total]:
    return [Total("min_date", F.min("first_at"), F.min), Total("max_date", F.max("last_at"), F.max)]


def users_with(fact: str, at_least: int) -> list[Total]:
    return [Total("count", F.count_if(F.col(fact) >= at_least))]


def offline_then_online() -> list[Total]:
    """Users with an offline map interaction, and those online again later.

    "Something happened after t" is the same as "the last one is after t".
    """
    return [
        Total("viewed_map_offline", F.sum(F.when(F.col("offline_map").isNotNull(), 1))),
        Total("came_back_online", F.sum(F.when(F.col("last_online") > F.col("offline_map"), 1))),
    ]


def ordered_funnel() -> list[Total]:
    """Users with a completion, and those with the final event afterwards."""
    return [
        Total("it_plus_plus_view_completed", F.sum(F.when(F.col("completed_at").isNotNull(), 1))),
        Total("transit_view_completed", F.sum(F.when(F.col("last_final") > F.col("completed_at"), 1))),
    ]


def add_up(users: DataFrame, totals: Sequence[Total]) -> DataFrame:
    return users.agg(*[t.column.alias(t.name) for t in totals])


def with_completion(users: DataFrame, kth: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add when a user had both the adds and the view; NULL for users who lack one."""
    both = F.col("first_view").isNotNull() & F.col("kth_time").isNotNull()
    return (
        users.join(kth, ["userid", *by], "left")
        .withColumn("completed_at", F.when(both, F.greatest("first_view", "kth_time")))
        .drop("kth_time")
    )


# -- reports straight from a cohort's events ---------------------------------


def unique_users_report(events: DataFrame) -> DataFrame:
    return add_up(user_facts(events), count_users())


def date_range_report(events: DataFrame) -> DataFrame:
    return events.agg(F.min("created_at").alias("min_date"), F.max("created_at").alias("max_date"))


def acquisition_report(events: DataFrame) -> DataFrame:
    rows = events.where(~F.col("event").isin(*N.IDLE_EVENTS))
    return add_up(user_facts(rows), users_with("actions", 1))


def activation_report(events: DataFrame, at_least: int = 1) -> DataFrame:
    rows = events.where(F.col("event").isin(*N.ACTIVATION_EVENTS))
    return add_up(user_facts(rows), users_with("activations", at_least))


def offline_then_online_report(events: DataFrame) -> DataFrame:
    rows = events.where((F.col("event") == "MapIteraction") | is_online(F.col("network")))
    return add_up(user_facts(rows), offline_then_online())


def completions_of(events: DataFrame, steps: FunnelSteps = FunnelSteps()) -> DataFrame:
    times = first_times(events, steps.add, steps.adds)
    return with_completion(user_facts(events, steps=steps), kth_time(times, steps.adds))


def _funnel_events(events: DataFrame, steps: FunnelSteps) -> DataFrame:
    """Only what the funnel looks at; the filter reaches the scan."""
    return events.where(F.col("event").isin(steps.add, steps.view, steps.final))


def ordered_funnel_report(events: DataFrame, steps: FunnelSteps = FunnelSteps()) -> DataFrame:
    return add_up(completions_of(_funnel_events(events, steps), steps), ordered_funnel())


def unordered_funnel_report(events: DataFrame, steps: FunnelSteps = FunnelSteps()) -> DataFrame:
    """Users with enough adds and at least one view, in any order."""
    per_user = events.groupBy("userid").agg(
        F.count_if(F.col("event") == steps.add).alias("adds"),
        F.count_if(F.col("event") == steps.view).alias("views"),
    )
    return per_user.agg(
        F.count_if((F.col("adds") >= steps.adds) & (F.col("views") >= 1)).alias("count")
    )


def drop_offs_report(events: DataFrame, steps: FunnelSteps = FunnelSteps()) -> DataFrame:
    """Labelled user counts from the whole group down to the unordered funnel."""
    per_user = events.groupBy("userid").agg(
        F.count_if(~F.col("event").isin(*N.IDLE_EVENTS)).alias("actions"),
        F.count_if(F.col("event").isin(*N.ACTIVATION_EVENTS)).alias("activations"),
        F.count_if(F.col("event") == steps.add).alias("adds"),
        F.count_if(F.col("event") == steps.view).alias("views"),
    )
    rules = (
        ("Users", F.lit(True)),
        ("acquisition", F.col("actions") >= 1),
        ("2.1 activation", F.col("activations") >= 1),
        ("2.2 activation", F.col("activations") >= 2),
        ("2.3 activation", (F.col("adds") >= steps.adds) & (F.col("views") >= 1)),
    )
    return labelled_counts(per_user, rules)


def labelled_counts(per_user: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """``description, count``: users meeting each rule, all counted in one pass."""
    counts = per_user.agg(*[F.count_if(rule).alias(f"c{i}") for i, (_, rule) in enumerate(rules)])
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(label).alias("description"), F.col(f"c{i}").alias("count"))
                    for i, (label, _) in enumerate(rules)
                ]
            )
        )
    )


def step_conversion_report(events: DataFrame, steps: FunnelSteps = FunnelSteps()) -> DataFrame:
    """Users, completions and finals with each step's share of the one before."""
    counts = completions_of(events, steps).agg(
        F.count(F.lit(1)).alias("a"),
        F.count("completed_at").alias("b"),
        F.count_if(F.col("last_final") > F.col("completed_at")).alias("c"),
    )
    rows = ((1, "users", "a", None), (2, "added and viewed", "b", "a"), (3, "went on", "c", "b"))
    steps_rows = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(step).alias("step"),
                        F.lit(name).alias("name"),
                        F.col(count).alias("users"),
                        (F.col(base) if base else F.lit(None).cast("bigint")).alias("of"),
                    )
                    for step, name, count, base in rows
                ]
            )
        )
    )
    share = F.try_divide(F.col("users") * 100.0, F.col("of"))
    return steps_rows.select("step", "name", "users", round_half_up(share, 1).alias("pct_of_previous"))


NEGATIVE_ABSENT = (
    ("Itinerary View", "ItineraryModeStart"),
    ("Transit mode", "TransitModeStart"),
    ("Map interaction", "MapIteraction"),
    ("DetailsChecked", "DetailsChecked"),
)


def negative_funnels_report(
    events: DataFrame,
    base_event: str = "ItineraryAdd",
    ks: Sequence[int] = (1, 2, 3),
    absent: Sequence[tuple[str, str]] = NEGATIVE_ABSENT,
) -> DataFrame:
    """Users with at least k adds, in total and lacking each of some events."""
    per_user = events.where(F.col("event").isin(base_event, *[e for _, e in absent])).groupBy("userid").agg(
        F.count_if(F.col("event") == base_event).alias("adds"),
        *[F.count_if(F.col("event") == e).alias(f"n{i}") for i, (_, e) in enumerate(absent)],
    )
    cells = []
    for k in ks:
        cells.append((f"it_plus >= {k}", F.col("adds") >= k))
        for i, (label, _) in enumerate(absent):
            cells.append((f"it_plus >= {k}, no {label}", (F.col("adds") >= k) & (F.col(f"n{i}") == 0)))
    return labelled_counts(per_user, cells)


def final_frequency_report(
    events: DataFrame, steps: FunnelSteps = FunnelSteps(), counted: str | None = None
) -> DataFrame:
    """Ordered funnel with a boxplot of how often an event follows completion.

    The counted event is added up per user and second before it meets the
    completions, so a heavy user brings few rows to the join.
    """
    counted = counted or steps.final
    done = completions_of(_funnel_events(events, steps), steps).where(F.col("completed_at").isNotNull())
    done = done.select("userid", "completed_at")
    seen = (
        events.where(F.col("event") == counted)
        .groupBy("userid", "activation_time")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    views = (
        done.join(seen, "userid", "left")
        .groupBy("userid")
        .agg(F.sum(F.when(F.col("activation_time") > F.col("completed_at"), F.col("n"))).alias("views"))
    )
    per_user = views.select(
        F.col("views").isNotNull().alias("seen"), F.coalesce("views", F.lit(0)).alias("views")
    )
    # two rows at most: users with and without such an event
    split = count_quantiles(per_user, ["seen"], "views", total="users")
    return split.agg(
        F.sum("users").alias("it_plus_plus_view_completed"),
        F.max(F.when(F.col("seen"), F.col("users"))).alias("transit_view_completed"),
        F.max(F.when(F.col("seen"), F.col("boxplot"))).alias("boxplot"),
    )
