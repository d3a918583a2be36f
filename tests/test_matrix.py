"""The report matrix against single runs, split users, and the report sinks."""

import csv
import json
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from footfall.operators import distributions, funnels, histories, retention
from footfall.operators.facts import Facts
from footfall.plans.cohorts import CohortSpec, Did, cohort_events
from footfall.session import stored
from footfall.plans.matrix import REPORTS, Matrix, run_matrix
from footfall.sinks.histories import export_histories
from footfall.sinks.reports import (
    folder_name, read_report_json, report_json_to_csv, write_report_csv, write_report_json,
)
from footfall.sources.events_table import SESSION_LIMIT_SECONDS as LIMIT
from footfall.sources.events_table import gazetteer, read_events_table
from tests.conftest import SF

START = date(2024, 1, 1)


def facts_of(spark, max_rows):
    log, hot = read_events_table(spark, SF, max_rows)
    return Facts(stored(log), hot, gazetteer(spark), keep=stored)


@pytest.fixture(scope="module")
def facts(spark):
    return facts_of(spark, 500_000)


@pytest.fixture(scope="module")
def split_facts(spark):
    facts = facts_of(spark, 20)
    assert facts.hot is not None and facts.logs.agg(F.max("slice")).first()[0] >= 3
    return facts


def plain(rows):
    return sorted((tuple(map(str, r)) for r in rows.collect()))


SINGLE = {
    "unique_users": lambda e, s: funnels.unique_users_report(e),
    "date_range": lambda e, s: funnels.date_range_report(e),
    "acquisition": lambda e, s: funnels.acquisition_report(e),
    "activation_1": lambda e, s: funnels.activation_report(e, 1),
    "activation_2": lambda e, s: funnels.activation_report(e, 2),
    "funnel_ordered": lambda e, s: funnels.ordered_funnel_report(e),
    "offline_then_online": lambda e, s: funnels.offline_then_online_report(e),
    "retention_boxplots": lambda e, s: retention.retention_boxplots_report(e, LIMIT),
    "retention_days": lambda e, s: retention.retention_days_report(e, LIMIT, sliced=s),
    "add_source_counts": lambda e, s: distributions.add_source_report(e),
    "event_distribution": lambda e, s: distributions.event_distribution_report(e),
}


@pytest.mark.parametrize("which", ["facts", "split_facts"])
@pytest.mark.parametrize("cohort, days", [("first_time_londoners", 7), ("first_time_row", 30), ("first_time_row_noexp", 14)])
def test_cells_equal_single_runs(request, which, cohort, days):
    facts = request.getfixturevalue(which)
    matrix = Matrix(facts, START, limit_seconds=LIMIT)
    end = START + timedelta(days=days)
    events = cohort_events(facts, cohort, START, end).cache()
    for report in REPORTS:
        if cohort not in report.groups:
            continue
        cell = matrix.table(report).where((F.col("usergroup") == cohort) & (F.col("date_end") == end))
        alone = SINGLE[report.name](events, facts.sliced).select(*report.fields)
        assert plain(cell.select(*report.fields)) == plain(alone), report.name


def test_split_users_change_nothing(facts, split_facts):
    def all_rows(f):
        matrix = Matrix(f, START, limit_seconds=LIMIT)
        return plain(matrix.rows().drop("fields"))

    assert all_rows(facts) == all_rows(split_facts)


def test_empty_cells_have_their_zeros(facts):
    matrix = Matrix(facts, date(2030, 1, 1))
    users = matrix.table(REPORTS[0])
    assert users.count() == 45 and users.agg(F.sum("total_count")).first()[0] == 0
    funnel = matrix.table(next(r for r in REPORTS if r.name == "funnel_ordered"))
    assert funnel.count() == 45 and funnel.where("transit_view_completed IS NOT NULL").count() == 0


def test_own_cohort_takes_part_in_every_report(facts):
    own = CohortSpec("buyers", "", True, did=Did("event = 'TransitListInfoOpen'"), drop_experimental=True)
    matrix = Matrix(facts, START, days=(30,), cohorts=[own, "first_time_londoners"], limit_seconds=LIMIT)
    titles = matrix.rows().groupBy("usergroup").agg(F.count_distinct("title").alias("n"))
    assert {r.usergroup: r.n for r in titles.collect()} == {"buyers": 11, "first_time_londoners": 11}
    events = cohort_events(facts, own, START, START + timedelta(days=30))
    cell = matrix.table(REPORTS[0]).where("usergroup = 'buyers'").first().total_count
    assert cell == events.select("userid").distinct().count() > 0


@pytest.fixture(scope="module")
def rows(facts):
    return run_matrix(facts, [START], limit_seconds=LIMIT, days=(7, 30), cohorts=["first_time_londoners", "first_time_row"]).cache()


def test_json_round_trip(spark, rows, tmp_path):
    path = str(tmp_path / "json")
    write_report_json(rows, path)
    first = json.loads(spark.read.text(path).first()[0])
    assert set(first) == {"date_start", "usergroup", "date_end", "categories"}
    assert isinstance(first["categories"]["universe"][0]["result"][0], dict)
    back = read_report_json(spark, path)
    def key(df):
        return sorted((r.row, str(r.date_end), r.usergroup, r.category_id, r.title, json.dumps(json.loads(r.result), sort_keys=True)) for r in df.collect())
    assert key(back) == key(rows)


def test_reports_without_rows_are_listed(spark, facts, tmp_path):
    matrix = Matrix(facts, date(2030, 1, 1), days=(7,))
    assert matrix.cells().count() == 111
    write_report_json(matrix.rows(), str(tmp_path), matrix.cells())
    documents = [json.loads(r[0]) for r in spark.read.text(str(tmp_path)).collect()]
    assert len(documents) == 13
    reports = [q for d in documents for c in d["categories"].values() for q in c]
    assert len(reports) == 111
    assert {q["title"]: q["result"] for q in reports}["Distribution of events."] == []


def test_csv_sections(spark, rows, tmp_path):
    folders = write_report_csv(rows, str(tmp_path / "csv"))
    assert len(folders) == len(REPORTS)
    title = "2.3/2.4 activation"
    cell = Path(folders[title]) / "date_start=2024-01-01" / "date_last=2024-01-07" / "usergroup=first_time_londoners"
    (file,) = cell.glob("*.csv")
    table = list(csv.DictReader(file.open()))
    assert table[0]["Group"] == "First time users in London." and table[0]["Query"] == title
    assert list(table[0])[2:] == ["it_plus_plus_view_completed", "transit_view_completed"]


def test_json_to_csv(spark, rows, tmp_path):
    write_report_json(rows, str(tmp_path / "j"))
    report_json_to_csv(spark, str(tmp_path / "j"), str(tmp_path / "a"))
    write_report_csv(rows, str(tmp_path / "b"))
    name = folder_name("3.1/3.3 Retention")
    days = [r.active_day for r in spark.read.option("header", True).csv(
        str(tmp_path / "a" / name / "date_start=2024-01-01" / "date_last=2024-01-30" / "usergroup=first_time_row")
    ).collect()]
    assert days == [str(d + 1) for d in range(len(days))] and len(days) > 5
    read = lambda d: plain(spark.read.option("header", True).csv(str(tmp_path / d / name)))
    assert read("a") == read("b") and read("a")


def test_history_export(spark, facts, tmp_path):
    users = histories.sample_users(facts.logs, 3, seed=5)
    path = tmp_path / "h"
    export_histories(histories.histories(facts.logs, users), str(path))
    folders = list(path.glob("user=*"))
    assert len(folders) == 3
    for folder in folders:
        got = [r for f in sorted(folder.glob("*.csv")) for r in csv.DictReader(f.open())]
        assert list(got[0])[-1] == "userid"
        times = [r["created_at"] for r in got]
        assert times == sorted(times)


def test_two_starts_equal_one_matrix_each_with_one_scan_of_the_log(facts):
    """Windows from two starts overlap; each report's rows are those of a matrix of its own."""
    from footfall.plans.matrix import run_matrix

    later = START + timedelta(days=2)
    both = Matrix(facts, [later, START], days=(3, 7), limit_seconds=LIMIT)
    alone = [Matrix(facts, s, days=(3, 7), limit_seconds=LIMIT) for s in (START, later)]
    for report in REPORTS:
        want = [(str(m.starts[0]), *r) for m in alone for r in plain(m.table(report))]
        assert plain(both.table(report)) == sorted(want), report.name
    scans = facts.between(*(both.cuts[0], both.cuts[-1])).inputFiles()
    plan = both.events._jdf.queryExecution().executedPlan().toString()
    assert scans and plan.count("FileScan") == 1  # the members' events are read from their own table
    long = run_matrix(facts, [START, later], (3, 7), reports=REPORTS[:2], limit_seconds=LIMIT)
    assert {str(r.date_start) for r in long.select("date_start").distinct().collect()} == {str(START), str(later)}


def test_more_starts_than_a_number_holds(facts):
    from footfall.plans.matrix import run_matrix

    starts = [START + timedelta(days=3 * k) for k in range(9)]
    got = run_matrix(facts, starts, (1, 2, 4, 5, 7, 8, 10), reports=REPORTS[:1], limit_seconds=LIMIT)
    want = Matrix(facts, starts[8], (1, 2, 4, 5, 7, 8, 10), reports=REPORTS[:1], limit_seconds=LIMIT).rows()
    assert got.count() == 9 * want.count()
    assert plain(got.where(F.col("date_start") == starts[8])) == plain(want)


def test_users_are_brought_together_before_rows_are_copied(facts):
    """Without hot users nothing is shuffled after rows went to all their windows; properties never are."""
    matrix = Matrix(facts, START, limit_seconds=LIMIT)
    parts = matrix.plain
    for table in (parts.counts, parts.sources, parts.users):
        plan = table._jdf.queryExecution().executedPlan().toString().split("Final Plan")[-1]
        above = plan[: plan.index("Generate explode")]
        assert "Exchange hashpartitioning" not in above and "Generate explode" in plan
    flagged = {(r.userid, r.session) for r in facts.experimental.collect()}
    rows = matrix.events.select("userid", "session", "event", "it_add_from", "experimental").collect()
    assert flagged and all(r.experimental == ((r.userid, r.session) in flagged) for r in rows)
    assert all(r.event == distributions.ADD_EVENT for r in rows if r.it_add_from is not None)
