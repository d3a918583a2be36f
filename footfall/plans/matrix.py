"""All windows, cohorts and reports in one go.

The starts and ends of all windows cut the log into stretches, and a window is a
range of them. Every per-user table is aggregated per stretch once, combined into
windows, and only then joined with the table of who belongs to which cohorts in
which window. The event log is read for the members' events and for the
membership tests, however many (start, window, cohort, report) cells there are.

A user's cohorts are one number with a bit per cohort. Rows are added up per
number first and handed out to the cohorts after that, so the many overlapping
cohorts do not multiply the per-user rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions.aggregates import falling, rising
from footfall.functions.scalars import in_range, json_text, starts_london
from footfall.operators import distributions, funnels, offline, retention, sessions
from footfall.operators.facts import Facts
from footfall.plans.cohorts import COHORTS, CohortSpec, Did
from footfall.plans.skew import join_users
from footfall.session import small_table, stored

BY = ("date_start", "date_end", "usergroup")
#: A number has a bit per cohort, another one a bit per stretch.
MAX_COHORTS = 62
MAX_STRETCHES = 62

# The cohorts each report is made for, and the reports' names,
# titles and fields further down.
_NINE = (
    "first_time_londoners", "first_time_row", "first_time_row_nolnd",
    "first_time_londoners_transit", "first_time_londoners_variant_1_branch_0",
    "first_time_londoners_variant_1_branch_1", "first_time_londoners_variant_1",
    "first_time_londoners_variant_0", "first_time_row_lnd",
)
_ELEVEN = (*_NINE, "first_time_londoners_gotvalue", "first_time_row_gotvalue")
_THIRTEEN = (*_ELEVEN, "first_time_londoners_noexp", "first_time_row_noexp")


@dataclass(frozen=True)
class Report:
    """A report: which per-user table it reads and how that adds up.

    Reports over the ``users`` table give aggregates in ``totals``, each with the
    way partial results merge; all of them are computed together, one row per
    cell, with ``zeros`` naming the counts that are 0, not NULL, in a cell
    without users. Others have any number of rows per cell: ``weigh`` adds up
    per-user rows to weighted values and ``rows`` makes the report of those, with
    ``order`` for the order of the rows.
    """

    name: str
    category_id: str
    title: str
    fields: tuple[str, ...]
    totals: Callable[[], list[funnels.Total]] | None = None
    part: str = "users"
    weigh: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None
    rows: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None
    usergroups: tuple[str, ...] = ()
    zeros: tuple[str, ...] = ()
    order: Callable[[], list[Column]] = lambda: [F.lit(1)]

    @property
    def groups(self) -> tuple[str, ...]:
        """A report without a list runs on every cohort."""
        return self.usergroups or tuple(COHORTS)


REPORTS: tuple[Report, ...] = (
    Report("unique_users", "universe", "#Unique users in user group (universe)", ("total_count",),
           funnels.count_users, usergroups=_NINE, zeros=("total_count",)),
    Report("date_range", "universe", "Min/Max date range from data (universe)", ("min_date", "max_date"),
           funnels.date_range, usergroups=_NINE),
    Report("acquisition", "acquisition", "Acquisition", ("count",),
           lambda: funnels.users_with("actions", 1), usergroups=_NINE, zeros=("count",)),
    Report("activation_1", "activation", "2.1 activation", ("count",),
           lambda: funnels.users_with("activations", 1), usergroups=_NINE, zeros=("count",)),
    Report("activation_2", "activation", "2.2 activation", ("count",),
           lambda: funnels.users_with("activations", 2), usergroups=_NINE, zeros=("count",)),
    Report("funnel_ordered", "activation", "2.3/2.4 activation",
           ("it_plus_plus_view_completed", "transit_view_completed"),
           funnels.ordered_funnel, usergroups=_NINE),
    Report("offline_then_online", "activation", "2.5 activation", ("viewed_map_offline", "came_back_online"),
           funnels.offline_then_online, usergroups=_NINE),
    Report("retention_boxplots", "retention", "3.1/3.3 Retention",
           ("active_day", "sessions_per_day_boxplot", "avg_usage_per_day_boxplot",
            "total_usage_per_day_boxplot", "unique_users"),
           part="days", weigh=retention.usage_values, rows=retention.usage_boxplots, usergroups=_ELEVEN,
           order=lambda: [rising("active_day")]),
    Report("retention_days", "retention", "3.2 Retention",
           ("came_back_day", "retention_count", "went_offline"),
           part="returns", weigh=retention.return_values, rows=retention.returning_users, usergroups=_ELEVEN,
           order=lambda: [rising("came_back_day")]),
    Report("add_source_counts", "general", "Distribution of pluses (itinerary add).",
           ("it_add_from", "num_of_pluses"),
           part="sources", weigh=distributions.add_source_values,
           rows=distributions.add_source_counts, usergroups=_THIRTEEN,
           order=lambda: [rising("num_of_pluses"), rising("it_add_from")]),
    Report("event_distribution", "general", "Distribution of events.", ("event", "median", "average"),
           part="counts", weigh=distributions.event_values,
           rows=distributions.event_distribution, usergroups=_THIRTEEN,
           order=lambda: [falling("median"), rising("event")]),
)


@dataclass(frozen=True)
class ReportWindow:
    """A window from ``start`` to before ``end``: the stretches from ``first`` to before ``last``."""

    start: date
    end: date
    first: int
    last: int

    @property
    def bits(self) -> int:
        return (1 << self.last) - (1 << self.first)

    @property
    def bits_from(self) -> int:
        """All stretches from the start on, as a signed number."""
        return -(1 << self.first)


@dataclass
class Parts:
    """Per-user tables by window, built from one set of events when first used."""

    events: DataFrame
    windows: Sequence[ReportWindow]
    limit_seconds: int
    sliced: bool
    excluded: Sequence[str] = field(default=N.RETENTION_RUN_EXCLUDED)

    def _spread(self, part: DataFrame) -> DataFrame:
        """Each row in every window that its stretch belongs to.

        Where no user is hot, users are brought together first: what is added up, ordered
        and joined per user and window after this needs no more shuffles of the copies.
        """
        if not self.sliced:
            part = part.repartition("userid")
        ranges = F.array(*[
            F.struct(F.lit(k).alias("window"), F.lit(w.first).alias("first"), F.lit(w.last).alias("last"))
            for k, w in enumerate(self.windows)
        ])
        stretch = F.col("stretch")
        mine = F.filter(ranges, lambda w: (w["first"] <= stretch) & (stretch < w["last"]))
        return part.withColumn("window", F.explode(mine["window"])).drop("stretch")

    def _combine(self, part: DataFrame, keys: Sequence[str], *merged: Column) -> DataFrame:
        return self._spread(part).groupBy("userid", *keys, "window").agg(*merged)

    @cached_property
    def users(self) -> DataFrame:
        facts = self._combine(
            funnels.user_facts(self.events, ["stretch"]), [],
            *[f(c).alias(c) for c, f in funnels.USER_FACTS_MERGE.items()],
        )
        steps = funnels.FunnelSteps()
        times = funnels.first_times(self.events, steps.add, steps.adds, ["stretch"]).drop("place")
        lowest = funnels.lowest_times(self._spread(times), steps.adds, ["window"])
        kth = funnels.kth_time(lowest, steps.adds, ["window"])
        return funnels.with_completion(facts, kth, ["window"])

    @cached_property
    def days(self) -> DataFrame:
        """Kept for the two retention reports."""
        bounds = self._combine(
            sessions.session_bounds(self.events, ["stretch"]), ["session"],
            F.min("started").alias("started"), F.max("ended").alias("ended"),
        )
        return stored(sessions.user_days(sessions.kept_sessions(bounds, self.limit_seconds), ["window"]))

    @cached_property
    def returns(self) -> DataFrame:
        runs = self._combine(
            offline.offline_runs(self.events, self.excluded, self.sliced, ["stretch"]), ["run"],
            F.min("started").alias("started"), F.sum("offline_times").alias("offline_times"),
        )
        return retention.return_days(self.days, runs, ["window"])

    @cached_property
    def sources(self) -> DataFrame:
        part = distributions.add_sources_per_user(self.events, ["stretch"])
        return self._combine(part, ["it_add_from"], F.sum("n").alias("n"))

    @cached_property
    def counts(self) -> DataFrame:
        part = distributions.events_per_user(self.events, ["stretch"])
        return self._combine(part, ["event"], F.sum("counts").alias("counts"))


class Matrix:
    """Every report for every cohort and conversion window from one start date or several.

    ``cohorts`` restricts the registered cohorts by name and may add specs of
    one's own; those take part in every report. Results of one start date do not
    name it, but for ``rows`` and ``cells``.
    """

    def __init__(
        self,
        facts: Facts,
        start: date | Sequence[date],
        days: Sequence[int] = N.CONVERSION_DAYS,
        reports: Sequence[Report] = REPORTS,
        cohorts: Sequence[str | CohortSpec] | None = None,
        limit_seconds: int = N.SESSION_LIMIT_SECONDS,
    ) -> None:
        self.facts = facts
        self.starts = [start] if isinstance(start, date) else sorted(set(start))
        spans = [(s, s + timedelta(days=d)) for s in self.starts for d in sorted(days)]
        self.cuts = sorted({day for span in spans for day in span})
        if len(self.cuts) > MAX_STRETCHES:
            raise ValueError(f"more than {MAX_STRETCHES} starts and ends of windows; see run_matrix")
        self.windows = [ReportWindow(s, e, self.cuts.index(s), self.cuts.index(e)) for s, e in spans]
        self.reports = list(reports)
        self.limit_seconds = limit_seconds
        listed = {g for r in self.reports for g in r.groups}
        named = [c for c in (COHORTS if cohorts is None else cohorts) if isinstance(c, str)]
        own = [c for c in cohorts or () if isinstance(c, CohortSpec)]
        self._own = {c.name for c in own}
        self.cohorts = [COHORTS[c] for c in named if c in listed] + own
        if len(self.cohorts) > MAX_COHORTS:
            raise ValueError(f"more than {MAX_COHORTS} cohorts")
        self._bits = {c.name: 1 << i for i, c in enumerate(self.cohorts)}

    @property
    def _shown(self) -> tuple[str, ...]:
        return BY if len(self.starts) > 1 else BY[1:]

    def _stretch(self, moment: str) -> Column:
        """Number of the stretch that holds a moment after the first start."""
        passed = [(F.col(moment) >= F.lit(cut)).cast("int") for cut in self.cuts[1:]]
        return sum(passed, F.lit(0))

    def _stretch_bit(self, moment: str) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), self._stretch(moment))

    def _in_any(self, moment: str) -> Column:
        """Whether the moment lies in any window."""
        widest = {w.start: w.end for w in self.windows}
        return reduce(Column.__or__, [in_range(F.col(moment), s, e) for s, e in widest.items()])

    @cached_property
    def _tests(self) -> dict[Did, str]:
        """The cohorts' conditions on events, each with a column name."""
        used = dict.fromkeys(d for c in self.cohorts for d in (c.did, c.did_not) if d)
        return {d: f"test_{i}" for i, d in enumerate(used)}

    @cached_property
    def candidates(self) -> DataFrame:
        """First-time users of any window: when they joined, and where."""
        return (
            self.facts.first_users.where(self._in_any("first_join"))
            .join(self.facts.first_cities, "userid")
            .select(
                "userid",
                self._stretch_bit("first_join").alias("joined"),
                starts_london(F.col("first_city")).alias("london"),
            )
        )

    @cached_property
    def events(self) -> DataFrame:
        """Events of all candidates in any window, shared by every report.

        Conditions on the window's events are tested here, once per event and before the
        properties would be shuffled; the source of an add is read on adds alone. Where a
        cohort leaves experimental sessions out, ``experimental`` tells their events. Users
        stay together in the written files, so the per-user aggregations shrink
        them before any shuffle.
        """
        rows = self.facts.between(self.cuts[0], self.cuts[-1])
        if len(self.starts) > 1:
            rows = rows.where(self._in_any("created_at"))
        users = self.candidates.select("userid")
        source = json_text(F.col("properties"), N.KEY_ADD_SOURCE)
        rows = rows.select(
            "userid", "event", "created_at", "session", "activation_time", "network",
            F.when(F.col("event") == distributions.ADD_EVENT, source).alias("it_add_from"),
            "event_id", "slice",
            self._stretch("created_at").alias("stretch"),
            *[d.column.alias(name) for d, name in self._tests.items() if not d.open_end],
        )
        rows = join_users(rows, users, self.facts.hot, "left_semi")
        if any(c.drop_experimental for c in self.cohorts):
            flagged = self.facts.experimental.select("userid", "session").distinct()
            rows = rows.join(flagged.withColumn("experimental", F.lit(True)), ["userid", "session"], "left")
            rows = rows.withColumn("experimental", F.coalesce("experimental", F.lit(False)))
        return stored(rows)

    @cached_property
    def members(self) -> DataFrame:
        """(userid, window, date_start, date_end, cohorts): the cohorts' bits of each user and window.

        What a user did, and when they got the value, is a number with a bit per stretch,
        so one table serves windows from any start.
        """
        facts, tests, users = self.facts, self._tests, self.candidates
        inner = [name for d, name in tests.items() if not d.open_end]
        if inner:
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("stretch"))
            met = self.events.groupBy("userid").agg(
                *[F.bit_or(F.when(F.col(name), bit)).alias(name) for name in inner]
            )
            users = users.join(met, "userid", "left")
        later = {d: name for d, name in tests.items() if d.open_end}
        if later:
            some = reduce(Column.__or__, [d.column for d in later])
            met = (
                facts.between(self.cuts[0])
                .where(some)
                .groupBy("userid")
                .agg(*[F.bit_or(F.when(d.column, self._stretch_bit("created_at"))).alias(name) for d, name in later.items()])
            )
            users = users.join(met, "userid", "left")
        if any(c.got_value for c in self.cohorts):
            got = (
                facts.got_value.where(self._in_any("created_at"))
                .groupBy("userid")
                .agg(F.bit_or(self._stretch_bit("created_at")).alias("got"))
            )
            users = users.join(got, "userid", "left")

        def within(column: str, bits: int) -> Column:
            return F.coalesce(F.col(column).bitwiseAND(F.lit(bits).cast("bigint")) != 0, F.lit(False))

        def inside(spec: CohortSpec, window: ReportWindow) -> Column:
            rule = within("joined", window.bits) & (F.col("london") == spec.london)
            for did, wanted in ((spec.did, True), (spec.did_not, False)):
                if did:
                    met = within(tests[did], window.bits_from if did.open_end else window.bits)
                    rule &= met if wanted else ~met
            if spec.got_value:
                rule &= within("got", window.bits)
            return rule

        windows = F.array(*[
            F.struct(
                F.lit(k).alias("window"),
                F.lit(window.start).alias("date_start"),
                F.lit(window.end).alias("date_end"),
                sum(
                    (F.when(inside(c, window), F.lit(self._bits[c.name])).otherwise(0) for c in self.cohorts),
                    F.lit(0).cast("bigint"),
                ).alias("cohorts"),
            )
            for k, window in enumerate(self.windows)
        ])
        return stored(
            users.select("userid", F.inline(windows)).where(F.col("cohorts") != 0)
        )

    def _parts(self, events: DataFrame) -> Parts:
        return Parts(events, self.windows, self.limit_seconds, self.facts.sliced)

    @cached_property
    def plain(self) -> Parts:
        return self._parts(self.events)

    @cached_property
    def clean(self) -> Parts:
        """The same without experimental sessions."""
        return self._parts(self.events.where(~F.col("experimental")))

    def _tagged(self, part: Parts, table: str) -> DataFrame:
        """Rows of a per-user table with the cohorts they count in."""
        return getattr(part, table).join(self.members, ["userid", "window"])

    def _hand_out(self, rows: DataFrame, names: Sequence[str]) -> DataFrame:
        """A row for each named cohort among the row's bits."""
        pairs = F.array(*[
            F.struct(F.lit(self._bits[n]).cast("bigint").alias("bit"), F.lit(n).alias("name")) for n in names
        ])
        cohorts = F.col("cohorts")
        mine = F.filter(pairs, lambda c: c["bit"].bitwiseAND(cohorts) != 0)
        return rows.withColumn("usergroup", F.explode(mine["name"])).drop("cohorts")

    def _over_cohorts(
        self, names: Sequence[str], table: str, add_up: Callable[[DataFrame], DataFrame]
    ) -> DataFrame:
        """``add_up`` per window and number of cohorts, then one row per cohort."""
        out = None
        for clean, part in ((False, "plain"), (True, "clean")):
            here = [c.name for c in self.cohorts if c.name in names and c.drop_experimental == clean]
            if here:
                rows = self._hand_out(add_up(self._tagged(getattr(self, part), table)), here)
                out = rows if out is None else out.unionByName(rows)
        return out

    def _runs_on(self, report: Report, name: str) -> bool:
        return name in report.groups or name in self._own

    def _single(self, reports: Sequence[Report]) -> DataFrame:
        """One row per cell with a struct of fields per report, in one pass."""
        names = [c.name for c in self.cohorts if any(self._runs_on(r, c.name) for r in reports)]
        totals = [(f"{r.name}.{t.name}", t) for r in reports for t in r.totals()]

        def add_up(rows: DataFrame) -> DataFrame:
            return rows.groupBy(*BY[:2], "cohorts").agg(*[t.column.alias(n) for n, t in totals])

        merged = self._over_cohorts(names, "users", add_up).groupBy(*BY).agg(
            *[t.merge(f"`{n}`").alias(n) for n, t in totals]
        )
        cells = small_table(
            self.facts.logs.sparkSession, [(w.start, w.end, name) for w in self.windows for name in names],
            "date_start date, date_end date, usergroup string",
        )

        def filled(report: Report) -> Column:
            values = {f: F.col(f"`{report.name}.{f}`") for f in report.fields}
            return F.struct(*[
                (F.coalesce(v, F.lit(0)) if f in report.zeros else v).alias(f) for f, v in values.items()
            ]).alias(report.name)

        return cells.join(merged, list(BY), "left").select(*BY, *[filled(r) for r in reports])

    def table(self, report: Report) -> DataFrame:
        """One report: its cell and its fields."""
        return self._table(report).select(*self._shown, *report.fields)

    def _table(self, report: Report) -> DataFrame:
        if report.totals:
            return self._single([report]).select(*BY, f"{report.name}.*")
        names = [c.name for c in self.cohorts if self._runs_on(report, c.name)]
        weighted = self._over_cohorts(
            names, report.part, lambda rows: report.weigh(rows, [*BY[:2], "cohorts"])
        )
        return report.rows(weighted, list(BY)).select(*BY, *report.fields)

    def tables(self) -> dict[str, DataFrame]:
        return {r.name: self.table(r) for r in self.reports}

    def cells(self) -> DataFrame:
        """Every (window, cohort, report), whether it has rows or not."""
        listed = [
            (w.start, w.end, c.name, r.category_id, r.title, list(r.fields))
            for w in self.windows for c in self.cohorts for r in self.reports if self._runs_on(r, c.name)
        ]
        return small_table(
            self.facts.logs.sparkSession, listed,
            "date_start date, date_end date, usergroup string, category_id string, title string, "
            "fields array<string>",
        )

    def rows(self) -> DataFrame:
        """Long result: one JSON row per report row, numbered within its cell."""

        def labels(report: Report, values: Column, place: Column) -> list[Column]:
            return [
                place.alias("row"),
                F.lit(report.category_id).alias("category_id"),
                F.lit(report.title).alias("title"),
                F.array(*[F.lit(f) for f in report.fields]).alias("fields"),
                F.to_json(values, {"ignoreNullFields": "false"}).alias("result"),
            ]

        out = []
        single = [r for r in self.reports if r.totals]
        if single:
            listed = [
                F.when(
                    F.col("usergroup").isin(*r.groups, *self._own),
                    F.struct(*labels(r, F.col(r.name), F.lit(1))),
                )
                for r in single
            ]
            out.append(
                self._single(single).select(
                    *BY, F.inline(F.filter(F.array(*listed), lambda cell: cell.isNotNull()))
                )
            )
        for report in self.reports:
            if not report.totals:
                # a cell holds the rows of one report: days, sources or event names
                place = F.row_number().over(Window.partitionBy(*BY).orderBy(*report.order()))
                out.append(
                    self._table(report).select(*BY, *labels(report, F.struct(*report.fields), place))
                )
        rows = out[0]
        for more in out[1:]:
            rows = rows.unionByName(more)
        return rows


def run_matrix(facts: Facts, starts: Sequence[date], days: Sequence[int] = N.CONVERSION_DAYS, **options) -> DataFrame:
    """Long result over any number of start dates, as many of them per scan of the log as have room in a number."""
    at_once = max(1, MAX_STRETCHES // (len(days) + 1))
    starts = sorted(set(starts))
    out = None
    for k in range(0, len(starts), at_once):
        rows = Matrix(facts, starts[k : k + at_once], days, **options).rows()
        out = rows if out is None else out.unionByName(rows)
    return out
