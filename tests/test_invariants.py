"""What must hold between reports and cohorts whatever the data."""

from datetime import date

from pyspark.sql import functions as F

from footfall.operators import funnels, retention, sessions
from footfall.operators.facts import Facts
from footfall.plans.cohorts import cohort_events
from footfall.plans.matrix import REPORTS, Matrix
from footfall.session import stored
from footfall.sources.events_table import SESSION_LIMIT_SECONDS as LIMIT
from footfall.sources.events_table import gazetteer, read_events_table
from tests.conftest import SF

START, END = date(2024, 1, 1), date(2024, 1, 31)


def facts_of(spark):
    log, hot = read_events_table(spark, SF)
    return Facts(stored(log), hot, gazetteer(spark), keep=stored)


def test_reports_agree_with_each_other(spark):
    facts = facts_of(spark)
    matrix = Matrix(facts, START, limit_seconds=LIMIT)
    single = matrix._single([r for r in REPORTS if r.totals])
    wrong = single.where(
        (F.col("activation_2.count") > F.col("activation_1.count"))
        | (F.col("activation_1.count") > F.col("unique_users.total_count"))
        | (F.col("funnel_ordered.transit_view_completed") > F.col("funnel_ordered.it_plus_plus_view_completed"))
        | (F.col("offline_then_online.came_back_online") > F.col("offline_then_online.viewed_map_offline"))
        | (F.col("date_range.min_date") > F.col("date_range.max_date"))
    )
    assert wrong.isEmpty() and single.count() == 45
    # longer windows hold at least the users of shorter ones
    users = {(r.usergroup, r.date_end): r.unique_users.total_count for r in single.collect()}
    for (group, end), n in users.items():
        assert all(n <= m for (g, e), m in users.items() if g == group and e > end)


def test_day_zero_counts_users_with_a_kept_session(spark):
    events = cohort_events(facts_of(spark), "first_time_londoners", START, END)
    kept = sessions.kept_sessions(sessions.session_bounds(events), LIMIT)
    days = {r.came_back_day: r.retention_count for r in retention.retention_days_report(events, LIMIT).collect()}
    assert days[0] == kept.select("userid").distinct().count()
    first = retention.retention_boxplots_report(events, LIMIT).where("active_day = 1").first()
    assert first.unique_users == days[0]


def test_cohorts_contain_each_other(spark):
    facts = facts_of(spark)

    def rows(name):
        return cohort_events(facts, name, START, date(2024, 1, 8)).select("userid", "event_id")

    outside, never, been = rows("first_time_row"), rows("first_time_row_nolnd"), rows("first_time_row_lnd")
    parts = never.unionByName(been)
    assert parts.exceptAll(outside).isEmpty() and outside.exceptAll(parts).isEmpty()
    for part, whole in (
        ("first_time_londoners_noexp", "first_time_londoners"),
        ("first_time_londoners_gotvalue", "first_time_londoners"),
        ("first_time_londoners_variant_1_branch_0", "first_time_londoners_variant_1"),
        ("first_time_row_noexp", "first_time_row"),
    ):
        assert rows(part).exceptAll(rows(whole)).isEmpty()
    assert rows("first_time_londoners").join(outside, "userid").isEmpty()


def test_funnel_steps_fall(spark):
    events = cohort_events(facts_of(spark), "first_time_londoners", START, END)
    steps = [r.users for r in funnels.step_conversion_report(events).orderBy("step").collect()]
    assert steps == sorted(steps, reverse=True)
    drops = {r.description: r["count"] for r in funnels.drop_offs_report(events).collect()}
    assert drops["Users"] >= drops["acquisition"] >= drops["2.1 activation"] >= drops["2.2 activation"]
    negative = funnels.negative_funnels_report(events).collect()
    by_label = {r.description: r["count"] for r in negative}
    assert all(by_label[f"it_plus >= {k}"] >= by_label[f"it_plus >= {k}, no DetailsChecked"] for k in (1, 2, 3))
    assert by_label["it_plus >= 1"] >= by_label["it_plus >= 2"] >= by_label["it_plus >= 3"]
