"""What the plans must and must not contain."""

from datetime import date

from pyspark.sql import functions as F

from footfall.operators import detectors, funnels
from footfall.operators.facts import Facts
from footfall.plans.cohorts import cohort_events
from footfall.sources.events_table import to_log
from footfall.sources.log_table import append_logs, read_logs
from tests.conftest import SF


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_log(spark, make_log, tmp_path):
    path = str(tmp_path / "log")
    make_log([{"at": i} for i in range(10)]).write.parquet(path)
    return spark.read.parquet(path)


def test_first_adds_are_limited_before_the_shuffle(spark, make_log, tmp_path):
    plan = plan_of(funnels.first_times(stored_log(spark, make_log, tmp_path), "ItineraryAdd", 2))
    below = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below and "PushedFilters: [IsNotNull(event), EqualTo(event,ItineraryAdd)]" in plan


def test_detectors_shuffle_a_log_once(spark, make_log, tmp_path):
    log = stored_log(spark, make_log, tmp_path)
    marked = detectors.mark(log, detectors.GotValueRule(), experimental=True, places=True)
    plan = plan_of(marked)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("+- Sort") == 2


def test_windows_prune_days_of_a_stored_log(spark, make_log, tmp_path):
    path = str(tmp_path / "days")
    append_logs(make_log([{"at": d * 86400, "event": "AppStartup"} for d in range(20)]), path)
    facts = Facts(read_logs(spark, path))
    events = cohort_events(facts, "first_time_londoners", date(2024, 1, 1), date(2024, 1, 8))
    assert events.count() == 7
    pruned = [p for p in plan_of(events).split("PartitionFilters: [")[1:] if p.startswith("isnotnull(event_date")]
    assert len(pruned) == 1 and "event_date" in pruned[0].split("]")[0]
    batch = detectors.with_batch(facts.logs, "2024-01-03", "2024-01-05", 1)
    assert batch.count() == 2 and "event_date" in plan_of(batch).split("PartitionFilters: [")[1].split("]")[0]


def test_adapter_reads_what_is_needed(spark):
    raw = spark.read.parquet(f"{SF}/events.parquet")
    users = to_log(raw, None).where(F.col("event") == "AppStartup").select("userid", "created_at")
    schema = plan_of(users).split("ReadSchema: struct<")[1].split(">")[0]
    assert "value" not in schema
    assert plan_of(users).count("Exchange hashpartitioning") == 1
