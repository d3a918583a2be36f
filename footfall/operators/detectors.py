"""Sequence detectors over ordered user histories.

Got-value moments, experimental sessions and the closest known location are
written as running columns (see ``plans.scan``), so one shuffle on the user and
one sort order serve all of them and no history is ever held as a whole. Only the
exact order of interleaved sessions needs a fold, over summaries of runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions.scalars import int_or_zero, is_offline, json_text, known_city
from footfall.plans.scan import HighestBefore, LastKnown, NextKnown, Previous, RunningSum, Step, scan
from footfall.plans.time_range import between
from footfall.session import stored

ORDER = ("created_at", "activation_time", "event_id")


def with_batch(logs: DataFrame, anchor: date | str, end: date | str | None, days: int) -> DataFrame:
    """Number the batch of ``days`` days each event falls in, from ``anchor`` on.

    Events before the anchor or from ``end`` on are outside every batch.
    """
    start = F.lit(anchor).cast("date")
    rows = between(logs, start, None if end is None else F.lit(end).cast("date"))
    return rows.withColumn("batch", F.floor(F.datediff(F.to_date("created_at"), start) / days).cast("int"))


def _keys(rows: DataFrame) -> list[str]:
    return ["userid", "batch"] if "batch" in rows.columns else ["userid"]


@dataclass(frozen=True)
class GotValueRule:
    """When an offline run counts as having got the value."""

    excluded: tuple[str, ...] = N.DETECTOR_EXCLUDED
    interval: int = N.OFFLINE_SECONDS
    min_events: int = N.OFFLINE_MIN_EVENTS


def mark(
    logs: DataFrame,
    rule: GotValueRule | None = None,
    experimental: bool = False,
    places: bool = False,
    poi_rule: bool = True,
    sliced: bool = False,
) -> DataFrame:
    """Add the asked-for columns to every event, all in two passes over one order.

    ``rule``: ``hit``, the event at which an offline run has lasted long enough.
    Within a run of offline events, an event after the first qualifies when at
    least ``interval`` seconds have passed and it is at least the
    ``min_events``-th of the run or a map interaction. Excluded events neither
    count nor end a run; any other event that is not offline ends it.

    ``experimental``: ``flagged``, an event at which the session looks like trying
    out the app, counted from where the session began.

    ``places``: ``place_before`` and ``place_after``, the previous and next known
    place with their activation times.
    """
    keys, at, event = _keys(logs), F.col("activation_time"), F.col("event")
    first: dict[str, Step] = {}
    second: dict[str, Step] = {}
    flags: dict[str, Column] = {}
    if places:
        place = F.when(known_city(F.col("city")), F.struct(F.col("city").alias("city"), at.alias("at")))
        # the backward sort comes first: all that follows runs forward in one order
        first |= {"place_after": NextKnown(place), "place_before": LastKnown(place)}
    if rule:
        counts = ~event.isin(*rule.excluded)
        offline = counts & is_offline(F.col("network"))
        starts = offline & ~is_offline(F.col("_before.network"))
        first["_position"] = RunningSum(F.when(counts, 1).otherwise(0))
        first["_before"] = LastKnown(F.when(counts, F.struct(F.col("network").alias("network"))))
        run = F.struct(at.alias("at"), F.col("_position").alias("position"))
        second["_start"] = LastKnown(F.when(starts, run), inclusive=True)
        size = F.col("_position") - F.col("_start.position") + 1
        enough = (size >= rule.min_events) | (event == "MapIteraction")
        flags["hit"] = offline & ~starts & (at - F.col("_start.at") >= rule.interval) & enough
    if experimental:
        add, remove, detail = (
            F.coalesce((event == name).cast("int"), F.lit(0))
            for name in ("ItineraryAdd", "ItineraryRemove", "DetailsChecked")
        )
        first |= {
            "_session": Previous(F.col("session")),
            "_adds": RunningSum(add), "_removes": RunningSum(remove), "_details": RunningSum(detail),
        }
        begins = ~F.col("session").eqNullSafe(F.col("_session"))
        base = F.struct(
            at.alias("at"),
            (F.col("_adds") - add).alias("adds"),
            (F.col("_removes") - remove).alias("removes"),
            (F.col("_details") - detail).alias("details"),
        )
        second["_base"] = LastKnown(F.when(begins, base), inclusive=True)
        adds = F.col("_adds") - F.col("_base.adds")
        changes = adds + F.col("_removes") - F.col("_base.removes")
        details = F.col("_details") - F.col("_base.details")
        too_fast = (changes >= N.MIN_CHANGES) & (at - F.col("_base.at") < changes * N.SECONDS_PER_CHANGE)
        unread = (adds >= N.MIN_CHANGES) & (adds > details * N.ADD_TO_DETAILS_RATIO)
        flags["flagged"] = too_fast | unread
        if poi_rule:
            # read before the shuffle, which then carries no properties
            poi = int_or_zero(json_text(F.col("properties"), N.KEY_COUNT))
            logs = logs.withColumn("_poi", F.when(event == "ItineraryAdd", poi))
            flags["flagged"] |= F.coalesce(F.col("_poi") > N.MAX_REAL_POI, F.lit(False))
    rows = scan(logs, keys, ORDER, first, sliced)
    if second:
        rows = scan(rows, keys, ORDER, second, sliced)
    helpers = [c for c in rows.columns if c.startswith("_")]
    return rows.withColumns(flags).drop(*helpers)


def choose_place(compat: bool = False) -> Column:
    """Closest known city given the neighbours; NULL when there is none.

    With ``compat`` the farther neighbour wins when both exist, which is what
    the original numbers were made with. On equal distance the next one wins.
    """
    before, after = F.col("place_before"), F.col("place_after")
    to_before = F.abs(F.col("activation_time") - before["at"])
    to_after = F.abs(after["at"] - F.col("activation_time"))
    take_before = to_before > to_after if compat else to_before < to_after
    return (
        F.when(known_city(F.col("city")), F.col("city"))
        .when(after.isNull(), before["city"])
        .when(before.isNull(), after["city"])
        .when(take_before, before["city"])
        .otherwise(after["city"])
    )


def resolve_region(rows: DataFrame, gazetteer: DataFrame, city: str, name: str = "region") -> DataFrame:
    """Region of a city by gazetteer.

    A city the gazetteer lacks stays as it is; no city at all is ``UNKNOWN``.
    """
    known = gazetteer.select(F.col("city").alias("_place"), F.col("region").alias("_region"))
    return (
        rows.join(known, F.col(city) == F.col("_place"), "left")
        .withColumn(name, F.coalesce(F.col("_region"), F.col(city), F.lit(N.UNKNOWN)))
        .drop("_place", "_region")
    )


def closest_location(
    logs: DataFrame, gazetteer: DataFrame, compat: bool = False, sliced: bool = False
) -> DataFrame:
    """Every event with the region of its closest known place."""
    rows = mark(logs, places=True, sliced=sliced).withColumn("place", choose_place(compat))
    return resolve_region(rows, gazetteer, "place", "location").drop("place_before", "place_after")


def got_value_hits(
    logs: DataFrame, rule: GotValueRule = GotValueRule(), sliced: bool = False
) -> DataFrame:
    """Events at which an offline run has lasted long enough."""
    return mark(logs, rule, sliced=sliced).where("hit").drop("hit")


def first_hits(hits: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """First got-value moment per user: session, time and closest region.

    With a ``batch`` column the first batch with a hit wins.
    """
    hit = F.struct("created_at", "session", "activation_time", "place")
    place_in_order = [*(c for c in _keys(hits) if c != "userid"), *ORDER]
    first = (
        hits.groupBy("userid")
        .agg(F.min_by(hit, F.struct(*place_in_order)).alias("hit"))
        .select("userid", "hit.*")
    )
    return resolve_region(first, gazetteer, "place", "city").select(
        "userid", "created_at", "session", "activation_time", "city"
    )


def got_value(
    logs: DataFrame,
    gazetteer: DataFrame,
    rule: GotValueRule = GotValueRule(),
    compat: bool = False,
    sliced: bool = False,
) -> DataFrame:
    """First got-value moment of each user.

    Places are looked up in the whole history, also among events the detector
    skips. With a ``batch`` column histories do not cross batches.
    """
    rows = mark(logs, rule, places=True, sliced=sliced).where("hit")
    return first_hits(rows.withColumn("place", choose_place(compat)), gazetteer)


def experimental_sessions(
    logs: DataFrame,
    poi_rule: bool = True,
    strict_order: bool = False,
    sliced: bool = False,
) -> DataFrame:
    """Distinct (user, session) pairs that look like trying out the app.

    Counters start anew whenever the session changes. ``strict_order`` also
    gives the exact answer when sessions interleave: events of a session that
    is already flagged are then skipped and do not reset other sessions.
    """
    if strict_order:
        rows = logs.select(
            *_keys(logs), *ORDER, "session", "event", "properties", *(["slice"] if sliced else [])
        )
        flagged = _strict_experimental(rows, poi_rule, sliced)
    else:
        flagged = mark(logs, experimental=True, poi_rule=poi_rule, sliced=sliced).where("flagged")
    return flagged.select("userid", "session").distinct()


def session_runs(rows: DataFrame, poi_rule: bool = True, sliced: bool = False) -> DataFrame:
    """Runs of consecutive events of one session, each summed up in a fixed number of values.

    Whether a run flags its session depends on what the session counted before it: on
    ``c`` changes since ``b``, ``a`` adds and ``d`` details. An event of the run does when
    its time less ``SECONDS_PER_CHANGE`` per change of the run so far is below
    ``b + SECONDS_PER_CHANGE * c``, with at least ``MIN_CHANGES - c`` changes so far; and
    likewise for adds and details. So the least such time (``fast``) and the greatest
    surplus of adds (``unread``) for each number of missing changes or adds say all.
    """
    keys, at = _keys(rows), F.col("activation_time")
    add, remove, detail = (
        F.coalesce((F.col("event") == name).cast("int"), F.lit(0)) for name in ("ItineraryAdd", "ItineraryRemove", "DetailsChecked")
    )
    poi = int_or_zero(json_text(F.col("properties"), N.KEY_COUNT)) > N.MAX_REAL_POI if poi_rule else F.lit(False)
    slim = rows.select(
        *keys, *ORDER, "session", *(["slice"] if sliced else []), add.alias("_add"), (add + remove).alias("_change"),
        detail.alias("_detail"), ((F.col("event") == "ItineraryAdd") & F.coalesce(poi, F.lit(False))).alias("_poi"),
    )
    first: dict[str, Step] = {
        "_session": Previous(F.struct("session")), "_adds": RunningSum(F.col("_add")),
        "_changes": RunningSum(F.col("_change")), "_details": RunningSum(F.col("_detail")),
    }
    begins = F.col("_session").isNull() | ~F.col("session").eqNullSafe(F.col("_session.session"))
    base = F.struct(
        at.alias("at"), (F.col("_adds") - F.col("_add")).alias("adds"),
        (F.col("_changes") - F.col("_change")).alias("changes"), (F.col("_details") - F.col("_detail")).alias("details"),
    )
    second: dict[str, Step] = {
        "run": RunningSum(begins.cast("int")), "_base": LastKnown(F.when(begins, base), inclusive=True),
    }
    counted = scan(scan(slim, keys, ORDER, first, sliced), keys, ORDER, second, sliced)
    adds, changes, details = (F.col(f"_{n}") - F.col(f"_base.{n}") for n in ("adds", "changes", "details"))
    missing = range(N.MIN_CHANGES + 1)
    return counted.groupBy(*keys, "run").agg(
        F.max("session").alias("session"), F.max("_base.at").alias("began"),
        *([F.min("slice").alias("slice")] if sliced else []),
        F.max(changes).alias("changes"), F.max(adds).alias("adds"), F.max(details).alias("details"),
        F.array(*[F.min(F.when(changes >= n, at - N.SECONDS_PER_CHANGE * changes)) for n in missing]).alias("fast"),
        F.array(*[F.max(F.when(adds >= n, adds - N.ADD_TO_DETAILS_RATIO * details)) for n in missing]).alias("unread"),
        F.max("_poi").alias("poi"),
    )


def _fold_runs(keys: list[str], schema: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sessions flagged by runs that come ordered by stretch and run; holds one stretch's open counters."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, current, flagged = None, None, set()
        adds = changes = details = began = 0
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                stretch = (*(r[k] for k in keys), r["stretch"])
                session = r["session"]
                if stretch != here:
                    here, current, flagged = stretch, None, set()
                if session in flagged:
                    continue
                if current != (session,):
                    current, adds, changes, details, began = (session,), 0, 0, 0, r["began"]
                fast = r["fast"][max(0, N.MIN_CHANGES - changes)]
                unread = r["unread"][max(0, N.MIN_CHANGES - adds)]
                if (
                    r["poi"]
                    or (fast is not None and fast < began + N.SECONDS_PER_CHANGE * changes)
                    or (unread is not None and unread > N.ADD_TO_DETAILS_RATIO * details - adds)
                ):
                    flagged.add(session)
                    out.append((*stretch[:-1], session))
                adds, changes, details = adds + r["adds"], changes + r["changes"], details + r["details"]
            names = [c.split()[0] for c in schema.split(", ")]
            yield pa.RecordBatch.from_pylist([dict(zip(names, o)) for o in out], schema=_arrow_schema(schema))

    return fold


def _arrow_schema(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _strict_experimental(rows: DataFrame, poi_rule: bool, sliced: bool) -> DataFrame:
    """Flagged sessions in exact order: one pass over run summaries that carries the open counters.

    Events of a session that is already flagged are skipped, so its neighbours' runs may
    join up. Runs are first grouped into stretches: between two stretches no session is
    open that has rows on both sides, so they do not depend on each other. A stretch of
    one run needs no order at all; the others are read in order, run by run, by tasks
    that hold the flagged sessions and counters of one stretch and nothing else.
    """
    keys = _keys(rows)
    runs = session_runs(rows, poi_rule, sliced)
    ends = runs.groupBy(*keys, "session").agg(F.max("run").alias("_last"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"e.{k}")) for k in (*keys, "session")]
    runs = runs.alias("r").join(ends.alias("e"), reduce(lambda a, b: a & b, same)).select("r.*", "e._last")
    runs = scan(runs, keys, ["run"], {"_open": HighestBefore(F.col("_last"))}, sliced)
    apart = F.col("_open").isNull() | (F.col("_open") < F.col("run"))
    # two ways on from here; a few values per run are written instead of reading the log twice
    runs = stored(scan(runs, keys, ["run"], {"stretch": RunningSum(apart.cast("int"))}, sliced))
    alone = apart & (F.col("_last") == F.col("run"))
    single = runs.where(alone).where(
        F.col("poi")
        | F.coalesce(F.get("fast", F.lit(N.MIN_CHANGES)) < F.col("began"), F.lit(False))
        | F.coalesce(F.get("unread", F.lit(N.MIN_CHANGES)) > 0, F.lit(False))
    ).select(*keys, "session")
    tangled = runs.where(~alone).select(
        *keys, "stretch", "run", *[F.col(c).cast("bigint").alias(c) for c in ("session", "began", "changes", "adds", "details")],
        F.col("fast").cast("array<bigint>").alias("fast"), F.col("unread").cast("array<bigint>").alias("unread"), "poi",
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tangled.select(*keys, "session").schema)
    ordered = tangled.repartition(*keys, "stretch").sortWithinPartitions(*keys, "stretch", "run")
    folded = ordered.mapInArrow(_fold_runs(keys, schema), schema)
    return single.unionByName(folded.withColumn("session", F.col("session").cast(rows.schema["session"].dataType)))


def detect(
    logs: DataFrame,
    gazetteer: DataFrame,
    anchor: date | str | None = None,
    end: date | str | None = None,
    days: int = N.DETECTOR_BATCH_DAYS,
    rule: GotValueRule = GotValueRule(),
    compat: bool = False,
    strict_order: bool = False,
    sliced: bool = False,
    keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> tuple[DataFrame, DataFrame]:
    """Got-value moments and experimental sessions, from one ordering of the log.

    With ``anchor`` in batches of ``days`` days, clipped at ``end``. ``keep`` is
    applied to the marked events both results come from; written out, the log
    is shuffled and sorted once for both.
    """
    rows = logs if anchor is None else with_batch(logs, anchor, end, days)
    marked = mark(rows, rule, experimental=not strict_order, places=True, sliced=sliced)
    if strict_order:
        marked = marked.withColumn("flagged", F.lit(False))
    marked = keep(
        marked.where(F.col("hit") | F.col("flagged"))
        .withColumn("place", choose_place(compat))
        .select(*_keys(rows), *ORDER, "session", "place", "hit", "flagged")
    )
    if strict_order:
        flagged = experimental_sessions(rows, strict_order=True, sliced=sliced)
    else:
        flagged = marked.where("flagged").select("userid", "session").distinct()
    return first_hits(marked.where("hit"), gazetteer), flagged
