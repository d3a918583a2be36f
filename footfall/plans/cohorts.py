"""Cohorts as data: a spec names its conditions, one compiler plans them all."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions.scalars import in_range, json_text, network_flag, starts_london
from footfall.operators.facts import Facts
from footfall.plans.skew import join_users

COLUMNS = (
    "userid", "event", "created_at", "session", "activation_time", "network", "it_add_from",
)


@dataclass(frozen=True)
class Did:
    """The user has an event with ``condition`` (SQL) in the window.

    ``open_end`` drops the window's upper bound.
    """

    condition: str
    open_end: bool = False

    @property
    def column(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


@dataclass(frozen=True)
class CohortSpec:
    name: str
    description: str
    london: bool
    did: Did | None = None
    did_not: Did | None = None
    got_value: bool = False
    drop_experimental: bool = False


def _property(key: str, value: str) -> str:
    return f"get_json_object(properties, '$.{key}') = '{value}'"


_LOST_BRANCH = f"NOT array_contains(json_object_keys(properties), '{N.KEY_BRANCH}')"
_IN_LONDON = Did(f"startswith(lower(city), '{N.LONDON_PREFIX}')", open_end=True)
_VARIANT_1 = _property(N.KEY_VARIANT, "1")

COHORTS: dict[str, CohortSpec] = {
    c.name: c
    for c in (
        CohortSpec("first_time_londoners", "First time users in London.", True),
        CohortSpec("first_time_londoners_gotvalue", "First time users in London, that got the value.",
                   True, got_value=True),
        CohortSpec("first_time_londoners_noexp", "First time users in London, excluding experimental sessions.",
                   True, drop_experimental=True),
        CohortSpec("first_time_londoners_transit", "First time users in London who opened transit.",
                   True, did=Did("event = 'TransitListInfoOpen'")),
        CohortSpec("first_time_londoners_variant_0", "First time users in London with app variant 0.",
                   True, did=Did(_property(N.KEY_VARIANT, "0"))),
        CohortSpec("first_time_londoners_variant_1", "First time users in London with app variant 1.",
                   True, did=Did(_VARIANT_1)),
        CohortSpec("first_time_londoners_variant_1_branch_1",
                   "First time users in London, variant 1, first add jumped to the itinerary.",
                   True, did=Did(f"{_VARIANT_1} AND {_property(N.KEY_BRANCH, '1')}")),
        CohortSpec("first_time_londoners_variant_1_branch_0",
                   "First time users in London, variant 1, first add did not jump.",
                   True, did=Did(f"{_VARIANT_1} AND {_property(N.KEY_BRANCH, '0')}")),
        CohortSpec("first_time_londoners_variant_1_branch_undefined",
                   "First time users in London, variant 1, no branch entered.",
                   True, did=Did(f"{_VARIANT_1} AND {_LOST_BRANCH}")),
        CohortSpec("first_time_row", "First time users outside London.", False),
        CohortSpec("first_time_row_nolnd", "First time users outside London, never in London since.",
                   False, did_not=_IN_LONDON),
        CohortSpec("first_time_row_lnd", "First time users outside London, in London since.",
                   False, did=_IN_LONDON),
        CohortSpec("first_time_row_gotvalue", "First time users outside London, that got the value.",
                   False, got_value=True),
        CohortSpec("first_time_row_noexp", "First time users outside London, excluding experimental sessions.",
                   False, drop_experimental=True),
    )
}


def _users_who(facts: Facts, did: Did, start, end) -> DataFrame:
    rows = facts.between(start, None if did.open_end else end)
    return rows.where(did.column).select("userid").distinct()


def members(facts: Facts, spec: CohortSpec, start, end) -> DataFrame:
    """Users of a cohort. ``did_not`` is an anti join on non-NULL ids."""
    city_rule = starts_london(F.col("first_city"))
    users = (
        facts.first_users.where(in_range(F.col("first_join"), start, end))
        .join(facts.first_cities.where(city_rule if spec.london else ~city_rule), "userid")
        .select("userid")
    )
    if spec.did:
        users = users.join(_users_who(facts, spec.did, start, end), "userid", "left_semi")
    if spec.did_not:
        users = users.join(_users_who(facts, spec.did_not, start, end), "userid", "left_anti")
    if spec.got_value:
        got = facts.got_value.where(in_range(F.col("created_at"), start, end))
        users = users.join(got, "userid", "left_semi")
    return users


def without_experimental(events: DataFrame, experimental: DataFrame) -> DataFrame:
    """Events of sessions that are not flagged."""
    return events.join(experimental, ["userid", "session"], "left_anti")


def cohort_events(facts: Facts, spec: CohortSpec | str, start, end) -> DataFrame:
    """Events of a cohort in ``[start, end)``.

    Besides ``COLUMNS`` the rows keep ``event_id`` (the order's tie-break) and
    ``slice`` (see ``plans.skew``), which the ordered reports need.
    """
    if isinstance(spec, str):
        spec = COHORTS[spec]
    events = facts.between(start, end)
    events = join_users(events, members(facts, spec, start, end), facts.hot, "left_semi")
    if spec.drop_experimental:
        events = without_experimental(events, facts.experimental)
    return events.select(
        "userid", "event", "created_at", "session", "activation_time", "network",
        json_text(F.col("properties"), N.KEY_ADD_SOURCE).alias("it_add_from"),
        "event_id", "slice",
    )


def group_events(facts: Facts, london: bool) -> DataFrame:
    """All events of London (or other) first-time users, without date limits.

    The network flag is read from the raw property; missing means online.
    """
    city_rule = starts_london(F.col("first_city"))
    users = (
        facts.first_users.join(facts.first_cities.where(city_rule if london else ~city_rule), "userid")
        .select("userid")
    )
    return join_users(facts.logs, users, facts.hot, "left_semi").select(
        "userid", "event", "created_at", "session", "activation_time",
        network_flag(json_text(F.col("properties"), N.KEY_NETWORK)).alias("network"),
        "event_id", "slice",
    )


def register_views(facts: Facts, start, end, names: Sequence[str] | None = None) -> list[str]:
    """Temporary view per cohort, for reports given as SQL text."""
    picked = list(names or COHORTS)
    for name in picked:
        cohort_events(facts, COHORTS[name], start, end).createOrReplaceTempView(name)
    return picked
