"""Headline timings: one JSON line with seconds per query.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores.
``prepare_log`` is the time to build and store the typed log; the other queries
start from it. Detectors and the matrix are run anew, not read from a stored
result. Every query runs to its end into a sink that drops the rows; the better
of two runs counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from checks import queries as Q
from footfall import configure
from footfall.operators import detectors, sessions
from footfall.operators.facts import Facts
from footfall.plans.matrix import Matrix
from footfall.session import stored
from footfall.sources import events_table

HEADLINE = (
    "unique_users", "funnel_ordered", "negative_funnels", "transit_frequency", "offline_then_online",
    "retention_boxplots", "retention_days", "event_distribution", "add_source_share", "map_confusion",
    "closest_location", "cohort_first_time_londoners", "cohort_first_time_row_nolnd", "scan_json_lift",
)
RUNS = 2


def finish(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("footfall-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    places = events_table.gazetteer(spark)

    def prepare() -> None:
        log, _ = events_table.read_events_table(spark, folder)
        stored(log)

    def matrix() -> None:
        finish(Matrix(facts, Q.START, limit_seconds=Q.LIMIT).rows())

    jobs = {"prepare_log": prepare}
    facts: Facts = Q.facts_of(spark, folder)
    for table in ("first_users", "first_cities", "got_value", "experimental"):
        getattr(facts, table)
    jobs |= {name: (lambda n=name: finish(Q.QUERIES[n](spark, folder))) for name in HEADLINE}
    jobs["detect_both"] = lambda: [
        finish(rows) for rows in detectors.detect(facts.logs, places, sliced=facts.sliced, keep=stored)
    ]
    jobs["got_value"] = lambda: finish(detectors.got_value(facts.logs, places, sliced=facts.sliced))
    jobs["experimental_sessions"] = lambda: finish(
        detectors.experimental_sessions(facts.logs, sliced=facts.sliced)
    )
    jobs["session_times"] = lambda: finish(sessions.session_times(facts.logs, Q.LIMIT))
    jobs["report_matrix"] = matrix

    seconds = {}
    for name, job in jobs.items():
        best = None
        for _ in range(RUNS):
            began = time.perf_counter()
            job()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
