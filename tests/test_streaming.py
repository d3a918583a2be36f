"""Streams give what the batch jobs give."""

import json

from pyspark.sql import functions as F

from footfall.operators.detectors import got_value_hits
from footfall.sources.events_table import read_events_table
from footfall.sources.json_events import normalize_events, read_lines
from footfall.sources.log_table import read_logs
from footfall.streaming.got_value import got_value_stream, use_state_store
from footfall.streaming.ingest import closed_day_counts, ingest_stream, read_line_stream
from tests.conftest import SF


def line(user, at, **extra):
    properties = {"time": at, "distinct_id": user, "WNSessionNumber": 1, "WNTimeSinceActivation": at % 1000, **extra}
    return json.dumps({"event": "MapIteraction", "properties": properties})


def test_ingest_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    base = 1704067200
    (source / "a.json").write_text("\n".join(line(f"u{i % 3}", base + i * 5000) for i in range(50)))
    paths = [str(tmp_path / n) for n in ("log", "rejects", "checkpoint")]

    def run():
        q = ingest_stream(read_line_stream(spark, str(source)), *paths)
        q.awaitTermination(120)
        assert q.exception() is None

    run()
    (source / "b.json").write_text("\n".join([line("u9", base + 7), "not json", '{"event": "X", "properties": {}}']))
    run()
    run()  # nothing new
    good, bad = normalize_events(read_lines(spark, str(source / "*.json")))
    stored = read_logs(spark, paths[0]).drop("event_date")
    assert stored.exceptAll(good).isEmpty() and good.exceptAll(stored).isEmpty()
    assert spark.read.json(paths[1]).count() == bad.count() == 2


def test_closed_days_wait_for_late_data(spark, tmp_path, make_log):
    day = 86400
    rows = [{"at": d * day + 60, "event": "A"} for d in (0, 0, 1, 4)]
    path = str(tmp_path / "log")
    make_log(rows).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    q = (
        closed_day_counts(stream).writeStream.format("memory").queryName("closed_days")
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination(120)
    got = {(str(r.day), r.events) for r in spark.table("closed_days").collect()}
    # two days behind the last event: day 4 less two days keeps only days 0 and 1
    assert got == {("2024-01-01", 2), ("2024-01-02", 1)}


def test_live_got_value_equals_batch(spark, tmp_path):
    use_state_store(spark)
    log, _ = read_events_table(spark, SF)
    log = log.cache()
    path = str(tmp_path / "log")
    # three files in time order, one per micro batch
    for part in range(3):
        days = (F.dayofmonth("created_at") > part * 10) & (F.dayofmonth("created_at") <= part * 10 + 10)
        log.where(days).drop("slice").coalesce(1).write.mode("append").parquet(path)
    stream = (
        spark.readStream.schema(spark.read.parquet(path).schema)
        .option("maxFilesPerTrigger", 1).parquet(path)
    )
    q = (
        got_value_stream(stream).writeStream.format("memory").queryName("live")
        .outputMode("append").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    assert q.exception() is None
    live = {tuple(r) for r in spark.table("live").collect()}
    batch = got_value_hits(log).groupBy("userid").agg(
        F.min_by(F.struct("created_at", "session", "activation_time"),
                 F.struct("created_at", "activation_time", "event_id")).alias("h")
    ).select("userid", "h.*")
    assert live == {tuple(r) for r in batch.collect()}
    assert live


def test_live_moments_wait_for_a_place_or_a_timer(spark, tmp_path, make_log):
    """The closest known place, also one that comes two micro batches later; none in time: the one before."""
    from footfall.streaming.got_value import located_got_value_stream

    use_state_store(spark)
    off = {"network": False, "city": None}

    def run_of(user, start):
        return [{"userid": user, "at": start + k * 200, **off} for k in range(5)]

    batches = [
        [{"userid": "a", "at": 0, "city": "Paris"}, *run_of("a", 3000), {"userid": "c", "at": 0, "city": "Paris"}, *run_of("c", 1000), *run_of("d", 50)],
        [{"userid": "b", "at": 2000, "event": "AppStartup", "city": None}, *run_of("b", 2500), {"userid": "d", "at": 5000, "city": "London", "event": "AppStartup"}],
        [{"userid": "a", "at": 4000, "city": "London"}, {"userid": "z", "at": 30 * 86400}],
    ]
    path = str(tmp_path / "log")
    for k, rows in enumerate(batches):
        make_log([r | {"event_id": 100 * k + i} for i, r in enumerate(rows)]).coalesce(1).write.mode("append").parquet(path)
    places = spark.createDataFrame([("Paris", "ROW"), ("London", "London")], "city string, region string")
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = (
        located_got_value_stream(stream, places, wait=86_400).writeStream.format("memory").queryName("located")
        .outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(300)
    assert query.exception() is None
    got = {r.userid: (r.activation_time, r.city) for r in spark.table("located").collect()}
    assert got == {"a": (3800, "London"), "b": (3300, "UNKNOWN"), "c": (1800, "ROW"), "d": (850, "London")}
