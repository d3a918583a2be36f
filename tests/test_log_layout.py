"""Appends, replaced days, loads and streams share one log; closed days stay closed."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import functions as F

from footfall.sources.json_events import LOG_COLUMNS
from footfall.sources.log_table import append_logs, ingest_increment, read_logs, replace_days
from footfall.streaming.ingest import closing_stream, ingest_stream, read_closed_days, read_line_stream

BASE, DAY = 1704067200, 86400  # 2024-01-01


def line(user, at, event="A"):
    return json.dumps({"event": event, "properties": {"time": at, "distinct_id": user, "WNSessionNumber": 1, "WNTimeSinceActivation": at % 1000}})


def users(spark, path):
    return sorted((r.userid, str(r.event_date)) for r in read_logs(spark, path).collect())


def test_all_writers_share_one_log(spark, make_log, tmp_path):
    log, source = str(tmp_path / "log"), tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text("\n".join(line("load", BASE + d * DAY) for d in range(3)))
    ingest_increment(spark, f"{source}/*.json", log, str(tmp_path / "rejects"), str(tmp_path / "mark"), date(2024, 2, 1))
    append_logs(make_log([{"userid": "append", "at": DAY}, {"userid": "append", "at": 9 * DAY}]).select(*LOG_COLUMNS), log)
    streamed = tmp_path / "lines"
    streamed.mkdir()
    (streamed / "b.json").write_text(line("stream", BASE + DAY + 5) + "\nnot json")
    ingest_stream(read_line_stream(spark, str(streamed)), log, str(tmp_path / "rejects"), str(tmp_path / "cp")).awaitTermination(120)
    day = [f"2024-01-{d:02d}" for d in range(1, 11)]
    assert users(spark, log) == sorted([("load", day[0]), ("load", day[1]), ("load", day[2]), ("append", day[1]), ("append", day[9]), ("stream", day[1])])
    assert spark.read.json(str(tmp_path / "rejects")).count() == 1

    new = make_log([{"userid": "new", "at": DAY + k} for k in range(3)]).select(*LOG_COLUMNS)
    for _ in range(2):  # a day is written anew whatever wrote it, and again
        replace_days(new, log)
        assert users(spark, log) == sorted([("load", day[0]), ("load", day[2]), ("append", day[9]), *[("new", day[1])] * 3])
    replace_days(read_logs(spark, log).drop("event_date").where(F.col("userid") == "append"), log)
    assert ("append", day[9]) in users(spark, log) and len(users(spark, log)) == 6
    plan = read_logs(spark, log).where("event_date = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_waiting_rows_of_older_loads_are_deleted(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for k in range(3):
        (source / f"{k}.json").write_text("\n".join(line(f"u{k}", BASE + d * DAY) for d in range(12)))
        ingest_increment(spark, f"{source}/*.json", str(tmp_path / "log"), str(tmp_path / "rejects"), str(tmp_path / "mark"), date(2024, 1, 6 + 2 * k))
    assert [p.name for p in (tmp_path / "mark" / "_waiting").glob("load=*")] == ["load=3"]
    assert read_logs(spark, str(tmp_path / "log")).count() == 3 * 8


def test_closed_open_and_late_rows_add_up(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out = {n: str(tmp_path / n) for n in ("log", "rejects", "late", "counts", "cp")}

    def run(name, lines):
        (source / name).write_text("\n".join(lines))
        query = closing_stream(read_line_stream(spark, str(source)), out["log"], out["rejects"], out["late"], out["counts"], out["cp"])
        query.awaitTermination(120)
        assert query.exception() is None

    def closed():
        return {(r.day.day, r.event): r.events for r in read_closed_days(spark, out["counts"]).collect()}

    run("a", [line(f"u{k}", BASE + k * DAY // 4, "AB"[k % 2]) for k in range(20)])  # days 1 to 5
    assert closed() == {(d, e): 2 for d in (1, 2) for e in "AB"}
    run("b", [line("late", BASE + 60), line("on time", BASE + 2 * DAY + 60), line("ahead", BASE + 6 * DAY), "broken"])
    assert closed() == {**{(d, e): 2 for d in (1, 2, 3, 4) for e in "AB"}, (3, "A"): 3}
    run("c", [line("late", BASE + 2 * DAY), line("late", BASE + 3 * DAY)])
    late = read_logs(spark, out["late"])
    assert late.count() == 3 and {r.userid for r in late.collect()} == {"late"}
    assert closed() == {**{(d, e): 2 for d in (1, 2, 3, 4) for e in "AB"}, (3, "A"): 3}
    assert read_logs(spark, out["log"]).count() + late.count() == 25
    still_open = read_logs(spark, out["log"]).where("event_date >= DATE'2024-01-05'").count()
    assert sum(closed().values()) + still_open + late.count() == 25
