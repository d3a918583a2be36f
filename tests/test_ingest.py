"""Raw lines to the log, loading by date, and the derived tables."""

import json
from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from footfall.operators.facts import first_cities
from footfall.sinks import tables
from footfall.sources.gazetteer import read_gazetteer
from footfall.sources.json_events import normalize_events
from footfall.sources.log_table import append_logs, ingest_increment, read_logs
from footfall.sources.ranges import date_batches_between

BASE = {"time": 1704067200, "distinct_id": "u", "WNSessionNumber": 1, "WNTimeSinceActivation": 5}


def lines(spark, *properties, event="A"):
    texts = [json.dumps({"event": event, "properties": {**BASE, **p}}) for p in properties]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def column(spark, name, *properties):
    log, _ = normalize_events(lines(spark, *properties))
    return [r[0] for r in log.select(name).collect()]


def test_defaults_depend_on_missing_or_null(spark):
    given = column(spark, "network", {}, {"WNNetworkAvailable": None}, {"WNNetworkAvailable": False}, {"WNNetworkAvailable": "false"})
    assert given == [True, None, False, False]
    given = column(spark, "city", {}, {"WNCity": None}, {"WNCity": "Paris"})
    assert given == ["NOLOCATION", None, "Paris"]


def test_coordinates(spark):
    box = {"WNUserLatitude": 51.5, "WNUserLongitude": "-0.1", "WNCity": "Paris"}
    given = column(
        spark, "city", box, {**box, "WNUserLatitude": 51.951883}, {**box, "WNUserLongitude": "?"},
        {**box, "WNUserLatitude": None}, {"WNUserLatitude": "NOLOCATION", "WNCity": "Paris"},
    )
    assert given == ["London", "Paris", "Paris", "Paris", "Paris"]


def test_numbers_are_cut(spark):
    assert column(spark, "activation_time", {"WNTimeSinceActivation": 5.9}, {"WNTimeSinceActivation": "7"}) == [5, 7]
    moment = column(spark, "created_at", {"time": 1704067200.9})[0]
    assert moment.replace(tzinfo=timezone.utc) == datetime(2024, 1, 1, tzinfo=timezone.utc)


def test_incomplete_lines_are_rejected(spark):
    bad = ['{"event": "A"}', "oops", '{"properties": {}}', json.dumps({"event": "A", "properties": {**BASE, "WNSessionNumber": "x"}})]
    df = spark.createDataFrame([(b,) for b in bad], "value string")
    log, rejects = normalize_events(df)
    assert log.count() == 0
    reasons = {r.value: r.reason for r in rejects.collect()}
    assert len(reasons) == 4 and reasons[bad[3]] == "session"
    # the properties text keeps everything
    kept, _ = normalize_events(lines(spark, {"Extra": {"a": [1, 2]}}))
    assert json.loads(kept.first().properties)["Extra"] == {"a": [1, 2]}


def test_date_batches(spark):
    def batches(*range_days):
        out = date_batches_between(spark, *range_days).orderBy("from_date").collect()
        return [(str(r.from_date), str(r.to_date)) for r in out]

    assert batches(date(2024, 1, 1), date(2024, 1, 31)) == [
        ("2024-01-01", "2024-01-15"), ("2024-01-16", "2024-01-30"), ("2024-01-31", "2024-01-31")
    ]
    assert batches(date(2024, 1, 2), date(2024, 1, 1)) == []


def test_increments(spark, tmp_path):
    day = 86400
    source = str(tmp_path / "in")
    lines(spark, *[{"time": BASE["time"] + d * day} for d in range(6)]).write.text(source)
    paths = [str(tmp_path / n) for n in ("log", "rejects", "mark")]

    def load(today):
        return ingest_increment(spark, source, *paths, today=today)

    def days():
        return sorted(str(r.event_date) for r in read_logs(spark, paths[0]).select("event_date").collect())

    assert load(date(2024, 1, 4)) == (None, date(2024, 1, 2))
    assert days() == ["2024-01-01", "2024-01-02"]
    assert load(date(2024, 1, 4)) is None
    assert load(date(2024, 1, 6)) == (date(2024, 1, 3), date(2024, 1, 4))
    assert days() == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]


def test_late_lines_and_rejects_of_increments(spark, tmp_path):
    day = 86400
    source = str(tmp_path / "in [1]")
    paths = [str(tmp_path / n) for n in ("log", "rejects", "mark")]

    def land(*days, bad=()):
        good = lines(spark, *[{"time": BASE["time"] + d * day} for d in days])
        good.union(spark.createDataFrame([(b,) for b in bad], "value string")).write.mode("append").text(source)

    def load(today):
        return ingest_increment(spark, source.replace("[", "?").replace("]", "?"), *paths, today=today)

    def days():
        return sorted(str(r.event_date) for r in read_logs(spark, paths[0]).select("event_date").collect())

    land(0, 1, 9, bad=["oops"])
    assert load(date(2024, 1, 10)) == (None, date(2024, 1, 8))
    land(3, bad=["late"])
    # a line of a loaded day that lands later is added, whether a day became due or not
    assert load(date(2024, 1, 10)) == (date(2024, 1, 8), date(2024, 1, 8))
    assert days() == ["2024-01-01", "2024-01-02", "2024-01-04"]
    assert load(date(2024, 1, 10)) is None
    land(1)
    assert load(date(2024, 1, 13)) == (date(2024, 1, 9), date(2024, 1, 11))
    # old files are not read again: their lines are there once, as are the rejects
    assert days() == ["2024-01-01", "2024-01-02", "2024-01-02", "2024-01-04", "2024-01-10"]
    assert sorted(r.value for r in spark.read.json(paths[1]).collect()) == ["late", "oops"]
    assert load(date(2024, 1, 14)) == (date(2024, 1, 12), date(2024, 1, 12))
    assert len(days()) == 5


def test_log_table_round_trip(spark, tmp_path):
    log, _ = normalize_events(lines(spark, {}, {"time": BASE["time"] + 90000}))
    path = str(tmp_path / "log")
    append_logs(log, path)
    append_logs(log, path)
    assert read_logs(spark, path).count() == 4
    plan = read_logs(spark, path).where(F.col("event_date") == "2024-01-02")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_derived_tables(spark, tmp_path, make_log):
    log = make_log([{"userid": "a", "event": "AppStartup"}, {"userid": "b", "city": "UNKNOWN"}])
    folder = str(tmp_path / "facts")
    tables.refresh_facts(log, folder)
    tables.refresh_facts(log, folder)
    users, cities = tables.read_facts(spark, folder)
    assert [r.userid for r in users.collect()] == ["a"]
    assert cities.exceptAll(first_cities(log)).isEmpty()

    path = str(tmp_path / "exp")
    tables.write_experimental_sessions(spark.createDataFrame([("a", [1, 2, 2])], "userid string, flagged array<int>"), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1), ("a", 2)]

    path = str(tmp_path / "got")
    hits = log.select("userid", F.when(F.col("userid") == "a", F.col("created_at")).alias("created_at"),
                      "session", "activation_time", "city")
    tables.write_got_value(hits, path)
    assert [r.userid for r in spark.read.parquet(path).collect()] == ["a"]

    path = str(tmp_path / "cohort")
    tables.save_cohort(log, path)
    assert spark.read.parquet(path).count() == 2


def test_gazetteer(spark, tmp_path):
    path = str(tmp_path / "g.csv")
    spark.createDataFrame([("Leeds", "United Kingdom"), ("Leeds", "United Kingdom"), (None, "ROW")], "city string, region string") \
        .write.option("header", True).csv(path)
    assert [tuple(r) for r in read_gazetteer(spark, path).collect()] == [("Leeds", "United Kingdom")]
