"""Every operator as a query over the driver's tables.

All queries run over the whole ``events`` table through the adapter of
``footfall.sources.events_table``. The log, the detections and the report
matrix' members are written once per session and shared between queries, as the
log table and its derived tables are in production.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import configure
from footfall import names as N
from footfall.functions import scalars as S
from footfall.functions.quantiles import quantiles
from footfall.functions.sketches import approximate_quantiles, rank_error
from footfall.operators import (
    detectors, distributions, facts as fact_ops, funnels, histories, offline, overlaps,
    retention, sessions,
)
from footfall.operators.facts import Detection, Facts
from footfall.plans import templates
from footfall.plans.cohorts import COHORTS, cohort_events, group_events
from footfall.plans.matrix import REPORTS, Matrix
from footfall.session import fresh_folder, stored
from footfall.sinks import histories as history_sink
from footfall.sinks import reports as report_sink
from footfall.sinks import tables
from footfall.sources import events_table
from footfall.sources.gazetteer import read_gazetteer
from footfall.sources.json_events import normalize_events
from footfall.sources.log_table import append_logs, ingest_increment, read_logs
from footfall.sources.ranges import date_batches
from footfall.streaming.got_value import located_got_value_stream, use_state_store
from footfall.streaming.ingest import closing_stream, ingest_stream, read_closed_days, read_line_stream

START, END = date(2024, 1, 1), date(2024, 1, 31)
LIMIT = events_table.SESSION_LIMIT_SECONDS
STEPS = funnels.FunnelSteps()
ABSENT = (
    ("Itinerary View", "ButtonPressToItinerary"),
    ("Transit mode", "TransitListInfoOpen"),
    ("Map interaction", "MapIteraction"),
    ("DetailsChecked", "DetailsChecked"),
)
MAP_EVENTS = {"opened": "MapIteraction", "transit": "TransitListInfoOpen", "details": "DetailsMapOpen"}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


@lru_cache(maxsize=8)
def _facts(spark: SparkSession, app: str, folder: str) -> Facts:
    configure(spark)
    log, hot = events_table.read_events_table(spark, folder)
    return Facts(stored(log), hot, events_table.gazetteer(spark), keep=stored)


def facts_of(spark: SparkSession, folder: str) -> Facts:
    return _facts(spark, spark.sparkContext.applicationId, folder)


@lru_cache(maxsize=4)
def _matrix(spark: SparkSession, app: str, folder: str) -> Matrix:
    return Matrix(facts_of(spark, folder), START, limit_seconds=LIMIT)


def matrix_of(spark: SparkSession, folder: str) -> Matrix:
    return _matrix(spark, spark.sparkContext.applicationId, folder)


def query(fn: Callable[[Facts], DataFrame]) -> Callable[[Facts], DataFrame]:
    """Register a function of the facts under its own name."""
    QUERIES[fn.__name__] = lambda spark, folder: fn(facts_of(spark, folder))
    return fn


def us(column: str | Column) -> Column:
    return F.unix_micros(F.col(column) if isinstance(column, str) else column)


def day_text(column: str) -> Column:
    return F.col(column).cast("date").cast("string")


def long(column: str) -> Column:
    return F.col(column).cast("bigint")


def points(column: str, prefix: str) -> list[Column]:
    """Boxplot array as five columns."""
    return [F.col(column)[i].alias(f"{prefix}_{p}") for i, p in enumerate(("p02", "p25", "p50", "p75", "p98"))]


def londoners(facts: Facts) -> DataFrame:
    return cohort_events(facts, "first_time_londoners", START, END)


# -- sources ----------------------------------------------------------------


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The events as JSON lines, some with missing, odd or null properties."""
    configure(spark)
    k = F.regexp_extract("props", "([0-9]+)", 1).try_cast("int")
    return spark.read.parquet(f"{folder}/events.parquet").select("event_id", "ts", "user_id", "event_type", k.alias("k")).select(
        F.concat(
            F.lit('{"event": "'), F.col("event_type"),
            F.lit('", "properties": {"time": '), F.unix_seconds(F.col("ts").cast("timestamp")), F.lit(".75"),
            F.when(F.col("k") == 99, "").otherwise(F.concat(F.lit(', "distinct_id": "'), F.col("user_id"), F.lit('"'))),
            F.lit(', "WNSessionNumber": '), F.col("k") % 7,
            F.lit(', "WNTimeSinceActivation": '),
            F.when(F.col("k") % 5 == 0, F.concat(F.col("event_id"), F.lit(".9"))).otherwise(F.col("event_id").cast("string")),
            F.when(F.col("k") % 3 == 0, "").when(F.col("k") % 3 == 1, ', "WNNetworkAvailable": false')
            .otherwise(', "WNNetworkAvailable": null'),
            F.when(F.col("k") < 10, "").when(F.col("k") < 15, ', "WNUserLatitude": "far", "WNUserLongitude": 0')
            .otherwise(F.concat(F.lit(', "WNUserLatitude": 5'), F.col("k") % 3, F.lit(".5, "),
                                F.lit('"WNUserLongitude": "0.'), F.col("k"), F.lit('"'))),
            F.when(F.col("k") % 4 == 0, "").otherwise(', "WNCity": "Paris"'),
            F.lit("}}"),
        ).alias("value")
    )


def _lifted(good: DataFrame) -> DataFrame:
    return good.select(
        "userid", "event", F.unix_seconds("created_at").alias("created_s"), long("session").alias("session"),
        "network", long("activation_time").alias("activation_time"), "city",
        S.json_key_absent(F.col("properties"), N.KEY_NETWORK).alias("no_network_key"),
    )


def _scan_json_lift(spark: SparkSession, folder: str) -> DataFrame:
    return _lifted(normalize_events(raw_lines(spark, folder))[0])


def _landed(spark: SparkSession, folder: str) -> tuple[str, str]:
    """A folder with the raw lines as files, and one for what becomes of them."""
    landed = fresh_folder(spark)
    raw_lines(spark, folder).write.text(landed)
    return landed, fresh_folder(spark)


def _in_three_loads(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Log and rejects of lines that land in three steps, each with lines of all days.

    The first load leaves later days for the second; all the third one finds is late.
    """
    lines = stored(raw_lines(spark, folder))
    landed, out = fresh_folder(spark), fresh_folder(spark)
    for step, today in enumerate((date(2024, 1, 12), date(2024, 2, 12), date(2024, 2, 12))):
        lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == step).write.mode("append").text(landed)
        ingest_increment(spark, landed, f"{out}/log", f"{out}/rejects", f"{out}/mark", today)
    return f"{out}/log", f"{out}/rejects"


def _ingest_increment(spark: SparkSession, folder: str) -> DataFrame:
    return _lifted(read_logs(spark, _in_three_loads(spark, folder)[0]))


def _ingest_increment_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What the loads rejected, each line once."""
    rejects = spark.read.schema("value string, reason string").json(_in_three_loads(spark, folder)[1])
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def _stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    landed, out = _landed(spark, folder)
    run = ingest_stream(read_line_stream(spark, landed), f"{out}/log", f"{out}/rejects", f"{out}/checkpoint")
    run.awaitTermination()
    return _lifted(read_logs(spark, f"{out}/log"))


def _ingest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = normalize_events(raw_lines(spark, folder))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def _date_batches(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    span = spark.read.parquet(f"{folder}/events.parquet").agg(
        F.to_date(F.min("ts")).alias("first_day"), F.to_date(F.max("ts")).alias("last_day")
    )
    return date_batches(span, "first_day", "last_day", 7).select(
        day_text("from_date").alias("from_date"), day_text("to_date").alias("to_date")
    )


QUERIES["scan_json_lift"] = _scan_json_lift
QUERIES["ingest_increment"] = _ingest_increment
QUERIES["ingest_increment_rejects"] = _ingest_increment_rejects
def _closed_day_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads, of which the second brings rows of days that the first closed: closed days and late rows."""
    out = fresh_folder(spark)
    read = lambda key: F.get_json_object("value", f"$.properties.{key}").cast("double").cast("bigint")
    lines = stored(raw_lines(spark, folder)).withColumn("day", F.dayofmonth(F.timestamp_seconds(read(N.KEY_TIME))))
    late = (F.col("day") <= 10) & (read(N.KEY_ACTIVATION) % 50 == 0)
    for rows in (lines.where((F.col("day") <= 20) & ~late), lines.where((F.col("day") > 20) | late)):
        rows.select("value").write.mode("append").text(f"{out}/in")
        run = closing_stream(
            read_line_stream(spark, f"{out}/in"), f"{out}/log", f"{out}/rejects", f"{out}/late", f"{out}/counts", f"{out}/checkpoint"
        )
        run.awaitTermination()
    closed = read_closed_days(spark, f"{out}/counts").withColumn("late", F.lit(False))
    beyond = read_logs(spark, f"{out}/late").groupBy(F.col("event_date").alias("day"), "event").agg(F.count("*").alias("events"))
    return closed.unionByName(beyond.withColumn("late", F.lit(True))).withColumn("day", day_text("day"))


QUERIES["closed_day_counts"] = _closed_day_counts
QUERIES["stream_ingest"] = _stream_ingest
QUERIES["ingest_rejects"] = _ingest_rejects
QUERIES["date_batches"] = _date_batches


@query
def bbox_city(facts: Facts) -> DataFrame:
    """Wider-London rule with coordinates made from the event's number."""
    lat = F.concat(F.lit("51."), F.col("event_id") % 1000)
    lon = F.concat(F.lit("0."), F.col("event_id") % 100)
    city = S.widen_london(lat, lon, F.coalesce(F.col("city"), F.lit(N.NO_LOCATION)))
    return facts.logs.select("event_id", city.alias("city"))


@query
def city_normalizer(facts: Facts) -> DataFrame:
    return facts.logs.groupBy(S.normalize_city(F.col("city")).alias("city")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def json_key_absent(facts: Facts) -> DataFrame:
    """Events without a branch key, per app variant text."""
    return (
        facts.logs.where(S.json_key_absent(F.col("properties"), N.KEY_BRANCH))
        .groupBy(S.json_text(F.col("properties"), N.KEY_VARIANT).alias("variant"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


@query
def network_default(facts: Facts) -> DataFrame:
    flag = S.network_flag(S.json_text(F.col("properties"), N.KEY_NETWORK))
    return facts.logs.groupBy("event", flag.alias("network")).agg(F.count(F.lit(1)).alias("events"))


@query
def safe_int(facts: Facts) -> DataFrame:
    poi = S.int_or_zero(S.json_text(F.col("properties"), N.KEY_COUNT))
    return facts.logs.groupBy("userid").agg(F.sum(poi).cast("bigint").alias("poi"))


@query
def region_lookup(facts: Facts) -> DataFrame:
    places = facts.logs.select("event_id", "city")
    table = events_table.gazetteer(places.sparkSession)
    return detectors.resolve_region(places, table, "city").select("event_id", "region")


# -- facts ------------------------------------------------------------------


@query
def first_time_users(facts: Facts) -> DataFrame:
    return facts.first_users.select("userid", us("first_join").alias("first_join_us"))


@query
def first_time_users_alt(facts: Facts) -> DataFrame:
    return fact_ops.first_time_users_by_session(facts.logs)


@query
def first_cities(facts: Facts) -> DataFrame:
    return facts.first_cities


@query
def first_cities_raw(facts: Facts) -> DataFrame:
    return fact_ops.first_cities(facts.logs, raw=True)


@query
def first_seen_places(facts: Facts) -> DataFrame:
    return fact_ops.first_seen_places(facts.logs).select("userid", "city", us("first_seen").alias("first_seen_us"))


@query
def never_located_users(facts: Facts) -> DataFrame:
    """Per user of one session: sessions where no event had a known place."""
    rows = facts.logs.withColumn("userid", F.concat_ws("/", "userid", "session"))
    return fact_ops.never_located_users(rows)


@query
def never_located_users_nulls(facts: Facts) -> DataFrame:
    rows = facts.logs.withColumn("userid", F.concat_ws("/", "userid", "session"))
    return fact_ops.never_located_users(rows, null_is_unknown=True)


@query
def users_between(facts: Facts) -> DataFrame:
    return histories.users_between(facts.logs, date(2024, 1, 8), date(2024, 1, 9))


@query
def session_times(facts: Facts) -> DataFrame:
    return sessions.session_times(facts.logs, LIMIT).select(
        "userid", long("session").alias("session"), us("session_started").alias("started_us"),
        "duration_us", long("active_day").alias("active_day"),
    )


@query
def offline_runs(facts: Facts) -> DataFrame:
    runs = offline.offline_runs(facts.logs, sliced=facts.sliced)
    return runs.select("userid", us("started").alias("started_us"), "offline_times")


@query
def offline_run_days(facts: Facts) -> DataFrame:
    runs = offline.offline_run_days(offline.offline_runs(facts.logs, sliced=facts.sliced))
    return runs.groupBy("userid", day_text("offline_moment").alias("offline_moment"), "offline_times").agg(
        F.count(F.lit(1)).alias("runs")
    )


@query
def offline_totals(facts: Facts) -> DataFrame:
    return offline.offline_totals(facts.logs).withColumn("offline_moment", day_text("offline_moment"))


# -- stored tables ------------------------------------------------------------


@query
def log_table(facts: Facts) -> DataFrame:
    """The log appended by day and read back."""
    path = fresh_folder(facts.logs.sparkSession)
    append_logs(facts.logs.drop("slice"), path)
    return read_logs(facts.logs.sparkSession, path).select(
        "userid", "event", us("created_at").alias("created_us"), long("session").alias("session"),
        "network", long("activation_time").alias("activation_time"), "city", "event_id",
        day_text("event_date").alias("event_date"),
    )


@query
def facts_tables(facts: Facts) -> DataFrame:
    spark, path = facts.logs.sparkSession, fresh_folder(facts.logs.sparkSession)
    tables.refresh_facts(facts.logs, path)
    users, cities = tables.read_facts(spark, path)
    return users.join(cities, "userid").select("userid", us("first_join").alias("first_join_us"), "first_city")


@query
def facts_merged(facts: Facts) -> DataFrame:
    """Facts kept up to date by three loads, each merged without a look at earlier ones."""
    spark, path = facts.logs.sparkSession, fresh_folder(facts.logs.sparkSession)
    for start, end in ((date(2024, 1, 11), date(2024, 1, 21)), (date(2024, 1, 1), date(2024, 1, 11)), (date(2024, 1, 21), None)):
        tables.merge_facts(facts.between(start, end), path)
    users, cities = tables.read_merged_facts(spark, path)
    return users.join(cities, "userid").select("userid", us("first_join").alias("first_join_us"), "first_city")


@query
def gazetteer_file(facts: Facts) -> DataFrame:
    """Places of the log written as a gazetteer file, read again and looked up."""
    spark, path = facts.logs.sparkSession, fresh_folder(facts.logs.sparkSession) + ".csv"
    region = F.when(F.col("city") == N.LONDON, N.LONDON).otherwise(N.REST_OF_WORLD)
    places = facts.logs.where(~F.col("city").isin(*N.UNKNOWN_PLACES)).select("city").distinct()
    places.withColumn("region", region).write.option("header", True).csv(path)
    rows = detectors.resolve_region(facts.logs, read_gazetteer(spark, path), "city")
    return rows.groupBy("region").agg(F.count("*").alias("events"))


@query
def got_value_table(facts: Facts) -> DataFrame:
    path = fresh_folder(facts.logs.sparkSession)
    tables.write_got_value(facts.got_value, path)
    return _got_rows(facts.logs.sparkSession.read.parquet(path))


@query
def experimental_sessions_table(facts: Facts) -> DataFrame:
    path = fresh_folder(facts.logs.sparkSession)
    tables.write_experimental_sessions(facts.experimental, path)
    return facts.logs.sparkSession.read.parquet(path).select("userid", long("session").alias("session"))


@query
def cohort_table(facts: Facts) -> DataFrame:
    path = fresh_folder(facts.logs.sparkSession)
    tables.save_cohort(cohort_events(facts, "first_time_londoners_noexp", START, END), path)
    return _cohort_rows(facts.logs.sparkSession.read.parquet(path))


@query
def history_export(facts: Facts) -> DataFrame:
    """The exported CSV files of ten users, read back."""
    path = fresh_folder(facts.logs.sparkSession)
    users = histories.sample_users(londoners(facts), 10, order=F.md5("userid"))
    history_sink.export_histories(histories.histories(facts.logs, users), path)
    rows = facts.logs.sparkSession.read.option("header", True).csv(path)
    return rows.select("event", "session", "activation_time", "network", "count_value", "userid")


def _report_json(spark: SparkSession, folder: str) -> DataFrame:
    """The matrix as JSON documents, read back and counted by cell."""
    path = fresh_folder(spark)
    report_sink.write_report_json(matrix_of(spark, folder).rows(), path)
    return _cells(report_sink.read_report_json(spark, path))


def _report_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The matrix as CSV files; one report read back."""
    folders = report_sink.write_report_csv(matrix_of(spark, folder).rows(), fresh_folder(spark))
    rows = spark.read.option("header", True).csv(folders["2.3/2.4 activation"])
    return rows.select(
        F.date_add(F.col("date_last").cast("date"), 1).cast("string").alias("date_end"), "usergroup",
        long("it_plus_plus_view_completed").alias("it_plus_plus_view_completed"),
        long("transit_view_completed").alias("transit_view_completed"),
    )


def _typed(rows: DataFrame, matrix: Matrix, name: str, value: Callable[[str], Column]) -> DataFrame:
    """A report's cells with its fields as the report has them; ``value`` gives a field's text."""
    report = next(r for r in REPORTS if r.name == name)
    kinds = {f.name: f.dataType for f in matrix.table(report).schema.fields}
    fields = [value(f).cast(kinds[f]).alias(f) for f in report.fields]
    return _flat(rows.select("date_end", "usergroup", *fields)).withColumn("date_end", day_text("date_end"))


def _report_values(name: str) -> Query:
    """One report's values, out of the JSON documents."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        path, matrix = fresh_folder(spark), matrix_of(spark, folder)
        report_sink.write_report_json(matrix.rows(), path)
        title = next(r.title for r in REPORTS if r.name == name)
        rows = report_sink.read_report_json(spark, path).where(F.col("title") == title)
        return _typed(rows, matrix, name, lambda f: F.get_json_object("result", f"$.{f}"))

    return run


def _report_json_to_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON documents turned into CSV files; the retention report read back."""
    path, out, matrix = fresh_folder(spark), fresh_folder(spark), matrix_of(spark, folder)
    report_sink.write_report_json(matrix.rows(), path)
    folders = report_sink.report_json_to_csv(spark, path, out)
    rows = spark.read.option("header", True).csv(folders["3.2 Retention"])
    rows = rows.withColumn("date_end", F.date_add(F.col("date_last").cast("date"), 1))
    return _typed(rows, matrix, "retention_days", F.col)


QUERIES["report_json_events"] = _report_values("event_distribution")
QUERIES["report_json_funnel"] = _report_values("funnel_ordered")
QUERIES["report_json_to_csv"] = _report_json_to_csv
QUERIES["report_json"] = _report_json
QUERIES["report_csv"] = _report_csv


# -- cohorts ----------------------------------------------------------------


def _cohort_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "userid", "event", us("created_at").alias("created_us"), long("session").alias("session"),
        long("activation_time").alias("activation_time"), "network", "it_add_from",
    )


def _cohort_query(name: str) -> Query:
    return lambda spark, folder: _cohort_rows(cohort_events(facts_of(spark, folder), name, START, END))


for _name in COHORTS:
    QUERIES[f"cohort_{_name}"] = _cohort_query(_name)


@lru_cache(maxsize=8)
def _sparse_facts(spark: SparkSession, app: str, folder: str) -> Facts:
    """Only what each user did in the first four days, where few users do everything."""
    facts = facts_of(spark, folder)
    return Facts(stored(facts.logs.where(F.col("activation_time") < 345_600)), facts.hot, events_table.gazetteer(spark), keep=stored)


def sparse_facts(spark: SparkSession, folder: str) -> Facts:
    return _sparse_facts(spark, spark.sparkContext.applicationId, folder)


def _sparse_query(name: str) -> Query:
    return lambda spark, folder: _cohort_rows(cohort_events(sparse_facts(spark, folder), name, START, END))


for _name in COHORTS:
    QUERIES[f"sparse_{_name}"] = _sparse_query(_name)


def _group(facts: Facts, london: bool) -> DataFrame:
    return group_events(facts, london).select(
        "userid", "event", us("created_at").alias("created_us"), long("session").alias("session"),
        long("activation_time").alias("activation_time"), "network",
    )


@query
def group_londoners(facts: Facts) -> DataFrame:
    return _group(facts, True)


@query
def group_row(facts: Facts) -> DataFrame:
    return _group(facts, False)


# -- reports ----------------------------------------------------------------


@query
def unique_users(facts: Facts) -> DataFrame:
    return funnels.unique_users_report(londoners(facts))


@query
def date_range(facts: Facts) -> DataFrame:
    return funnels.date_range_report(londoners(facts)).select(
        us("min_date").alias("min_us"), us("max_date").alias("max_us")
    )


@query
def acquisition(facts: Facts) -> DataFrame:
    return funnels.acquisition_report(londoners(facts))


@query
def activation_1(facts: Facts) -> DataFrame:
    return funnels.activation_report(londoners(facts), 1)


@query
def activation_2(facts: Facts) -> DataFrame:
    return funnels.activation_report(londoners(facts), 2)


@query
def funnel_unordered(facts: Facts) -> DataFrame:
    return funnels.unordered_funnel_report(londoners(facts), STEPS)


@query
def funnel_ordered(facts: Facts) -> DataFrame:
    return funnels.ordered_funnel_report(londoners(facts), STEPS)


@query
def kth_add(facts: Facts) -> DataFrame:
    rows = londoners(facts)
    return funnels.kth_time(funnels.first_times(rows, STEPS.add, 2), 2).select(
        "userid", long("kth_time").alias("kth_time")
    )


@query
def step_conversion(facts: Facts) -> DataFrame:
    return funnels.step_conversion_report(londoners(facts), STEPS).select(
        long("step").alias("step"), "name", "users", F.col("pct_of_previous").cast("double").alias("pct_of_previous")
    )


@query
def drop_offs(facts: Facts) -> DataFrame:
    return funnels.drop_offs_report(londoners(facts), STEPS)


@query
def offline_then_online(facts: Facts) -> DataFrame:
    return funnels.offline_then_online_report(londoners(facts))


@query
def negative_funnels(facts: Facts) -> DataFrame:
    return funnels.negative_funnels_report(londoners(facts), absent=ABSENT)


@query
def transit_frequency(facts: Facts) -> DataFrame:
    out = funnels.final_frequency_report(londoners(facts), STEPS)
    return out.select(
        "it_plus_plus_view_completed", "transit_view_completed", *points("boxplot", "views")
    )


def _boxplots(rows: DataFrame) -> DataFrame:
    return rows.select(
        long("active_day").alias("active_day"), "unique_users",
        *points("sessions_per_day_boxplot", "sessions"),
        *points("avg_usage_per_day_boxplot", "avg"),
        *points("total_usage_per_day_boxplot", "total"),
    )


@query
def retention_boxplots(facts: Facts) -> DataFrame:
    return _boxplots(retention.retention_boxplots_report(londoners(facts), LIMIT))


@query
def retention_boxplots_index(facts: Facts) -> DataFrame:
    return _boxplots(retention.retention_boxplots_report(londoners(facts), LIMIT, rule="index"))


@query
def retention_days(facts: Facts) -> DataFrame:
    out = retention.retention_days_report(londoners(facts), LIMIT, sliced=facts.sliced)
    return out.withColumn("came_back_day", long("came_back_day"))


@query
def add_source_counts(facts: Facts) -> DataFrame:
    return distributions.add_source_report(londoners(facts))


@query
def add_source_share(facts: Facts) -> DataFrame:
    return distributions.add_source_share(facts.logs).withColumn("percentage", F.col("percentage").cast("double"))


@query
def event_distribution(facts: Facts) -> DataFrame:
    return distributions.event_distribution_report(londoners(facts))


@query
def map_confusion(facts: Facts) -> DataFrame:
    out = distributions.map_confusion_report(facts.logs, facts.first_cities, facts.experimental)
    return out.select(*points("ratio", "ratio"))


@query
def map_ratio(facts: Facts) -> DataFrame:
    return distributions.details_map_ratio(facts.logs, facts.first_cities, facts.experimental)


@query
def map_viewers(facts: Facts) -> DataFrame:
    return distributions.map_viewers_report(distributions.map_use(facts.logs, **MAP_EVENTS), facts.first_cities)


@query
def poi_swipe_viewers(facts: Facts) -> DataFrame:
    use = distributions.map_use(facts.logs, **MAP_EVENTS)
    return distributions.map_viewers_who(facts.logs, use, facts.first_cities, "ItineraryRemove")


@query
def map_flag_combos(facts: Facts) -> DataFrame:
    cells = distributions.map_flag_combinations(
        distributions.map_use(
            facts.logs.withColumn("userid", F.concat_ws("/", "userid", "session")), **MAP_EVENTS
        )
    )
    return cells.withColumn("pct", F.col("pct").cast("double"))


@query
def overlap_gotvalue(facts: Facts) -> DataFrame:
    return overlaps.users_in_both(facts.got_value, londoners(facts))


@query
def overlap_experimental(facts: Facts) -> DataFrame:
    return overlaps.users_in_both(facts.experimental, londoners(facts))


@query
def overlap_both(facts: Facts) -> DataFrame:
    return overlaps.experimental_and_got_value(facts.experimental, facts.got_value, londoners(facts))


@query
def gotvalue_not_experimental(facts: Facts) -> DataFrame:
    return overlaps.got_value_not_experimental(facts.experimental, facts.got_value, londoners(facts))


@query
def gotvalue_not_in_experimental(facts: Facts) -> DataFrame:
    """The NULL-aware form."""
    return overlaps.got_value_not_experimental(
        facts.experimental, facts.got_value, londoners(facts), null_aware=True
    )


@query
def user_histories(facts: Facts) -> DataFrame:
    """Histories of ten users drawn in a fixed order."""
    users = histories.sample_users(londoners(facts), 10, order=F.md5("userid"))
    return histories.histories(facts.logs, users).select(
        "event", "string_value", long("session").alias("session"),
        long("activation_time").alias("activation_time"), "network",
        us("created_at").alias("created_us"), "count_value", "userid",
    )


@query
def sample_users(facts: Facts) -> DataFrame:
    """Ten random cohort users; which ones is up to the seed."""
    return histories.sample_users(londoners(facts), 10, seed=7)


@query
def sample_users_by_event(facts: Facts) -> DataFrame:
    """Ten users, each as likely as it has events."""
    return histories.sample_users(facts.logs, 10, seed=7, by="weight")


@query
def sql_template(facts: Facts) -> DataFrame:
    londoners(facts).createOrReplaceTempView("template_cohort")
    return templates.run_template(
        facts.logs.sparkSession,
        "SELECT event, count(*) AS events FROM IDENTIFIER(:view) "
        "WHERE created_at >= :date_start GROUP BY event",
        "template_cohort",
        date_start=date(2024, 1, 15),
    )


# -- detectors --------------------------------------------------------------


def _got_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "userid", us("created_at").alias("created_us"), long("session").alias("session"),
        long("activation_time").alias("activation_time"), "city",
    )


@query
def got_value(facts: Facts) -> DataFrame:
    return _got_rows(facts.got_value)


@query
def got_value_live(facts: Facts) -> DataFrame:
    """The log as a stream, followed by a row far ahead in time that lets all waiting moments go."""
    spark, out = facts.logs.sparkSession, fresh_folder(facts.logs.sparkSession)
    log = facts.logs.drop("slice")
    log.write.parquet(f"{out}/log")
    ahead = log.groupBy().agg(F.max("created_at").alias("created_at")).where("created_at is not null").select(
        *[(F.col(c) + F.expr("INTERVAL 100 DAYS")).alias(c) if c == "created_at" else F.lit("" if c in ("userid", "event") else None).cast(t).alias(c) for c, t in log.dtypes]
    )
    ahead.write.mode("append").parquet(f"{out}/log")
    use_state_store(spark)
    stream = spark.readStream.schema(log.schema).parquet(f"{out}/log")
    moments = located_got_value_stream(stream, events_table.gazetteer(spark))
    run = (
        moments.writeStream.format("parquet").option("path", f"{out}/moments").option("checkpointLocation", f"{out}/checkpoint")
        .outputMode("append").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return _got_rows(spark.read.schema(moments.schema).parquet(f"{out}/moments"))


@query
def experimental_sessions(facts: Facts) -> DataFrame:
    return facts.experimental.select("userid", long("session").alias("session"))


@query
def experimental_sessions_no_poi(facts: Facts) -> DataFrame:
    return detectors.experimental_sessions(facts.logs, poi_rule=False, sliced=facts.sliced).select(
        "userid", long("session").alias("session")
    )


def _batched(facts: Facts) -> tuple[DataFrame, DataFrame]:
    return detectors.detect(
        facts.logs, events_table.gazetteer(facts.logs.sparkSession),
        START, END, days=7, sliced=facts.sliced,
    )


def interleaved(facts: Facts) -> DataFrame:
    """The log with three sessions open at a time: what sessions of four gaps hold, dealt out by event."""
    block = F.floor((F.col("session") - 1) / 4) * 4
    return facts.logs.withColumn("session", (block + F.pmod("event_id", F.lit(3))).cast("int"))


@query
def experimental_sessions_strict(facts: Facts) -> DataFrame:
    """Interleaved sessions in exact order."""
    flagged = detectors.experimental_sessions(interleaved(facts), strict_order=True, sliced=facts.sliced)
    return flagged.select("userid", long("session").alias("session"))


def _monthly(facts: Facts) -> Facts:
    """Detections in batches of 30 days from mid December on, so that two batches meet within the log."""
    return facts.detected(Detection(date(2023, 12, 15), END, 30))


@query
def got_value_monthly(facts: Facts) -> DataFrame:
    return _got_rows(_monthly(facts).got_value)


@query
def experimental_sessions_monthly(facts: Facts) -> DataFrame:
    return _monthly(facts).experimental.select("userid", long("session").alias("session"))


@query
def cohort_noexp_monthly(facts: Facts) -> DataFrame:
    """Londoners without the sessions that monthly detection flags."""
    return _cohort_rows(cohort_events(_monthly(facts), "first_time_londoners_noexp", START, END))


@query
def got_value_weekly(facts: Facts) -> DataFrame:
    return _got_rows(_batched(facts)[0])


@query
def experimental_sessions_weekly(facts: Facts) -> DataFrame:
    return _batched(facts)[1].select("userid", long("session").alias("session"))


def _closest(facts: Facts, compat: bool) -> DataFrame:
    table = events_table.gazetteer(facts.logs.sparkSession)
    return detectors.closest_location(facts.logs, table, compat, facts.sliced).select("event_id", "location")


@query
def closest_location(facts: Facts) -> DataFrame:
    return _closest(facts, False)


@query
def closest_location_compat(facts: Facts) -> DataFrame:
    return _closest(facts, True)


# -- statistics -------------------------------------------------------------


def _quantile_query(facts: Facts, rule: str) -> DataFrame:
    """Five-point distribution of activation times per event."""
    out = quantiles(facts.logs, ["event"], "activation_time", rule=rule)
    out = out.withColumn("boxplot", F.transform("boxplot", lambda v: v.cast("bigint")))
    return out.select("event", *points("boxplot", "time"))


@query
def boxplot_agg(facts: Facts) -> DataFrame:
    return _quantile_query(facts, "index")


@query
def percentile_agg(facts: Facts) -> DataFrame:
    return _quantile_query(facts, "disc")


@query
def percentile_sketches(facts: Facts) -> DataFrame:
    """Whether sketches of users' weeks, merged, give each event's percentiles within twice their bound of rank."""
    rows = facts.logs.withColumn("week", F.weekofyear("created_at"))
    points = list(enumerate(N.BOXPLOT_POINTS))
    guess = approximate_quantiles(rows, ["event"], "activation_time", total="n", parts=["userid", "week"])
    each = F.array(*[F.struct(F.lit(p).alias("point"), F.col("boxplot")[i].alias("value")) for i, p in points])
    guess = guess.select("event", "n", F.explode(each).alias("q")).select("event", "n", "q.*")
    ranks = rows.join(guess, "event").groupBy("event", "point", "n").agg(
        F.count_if(F.col("activation_time") < F.col("value")).alias("below"), F.count_if(F.col("activation_time") <= F.col("value")).alias("upto")
    )
    off = F.greatest(F.col("below") / F.col("n") - F.col("point"), F.col("point") - F.col("upto") / F.col("n"), F.lit(0.0))
    return ranks.select("event", "point", "n", (off <= 2 * rank_error()).alias("within"))


# -- report matrix ----------------------------------------------------------


def _flat(rows: DataFrame) -> DataFrame:
    """Plain columns: dates as text, times in microseconds, arrays by point."""
    prefixes = {
        "sessions_per_day_boxplot": "sessions", "avg_usage_per_day_boxplot": "avg",
        "total_usage_per_day_boxplot": "total",
    }
    columns: list[Column] = []
    for f in rows.schema.fields:
        kind = f.dataType.simpleString()
        if f.name in prefixes:
            columns += points(f.name, prefixes[f.name])
        elif kind == "date":
            columns.append(day_text(f.name).alias(f.name))
        elif kind == "timestamp":
            columns.append(us(f.name).alias(f.name))
        elif kind == "int":
            columns.append(long(f.name).alias(f.name))
        else:
            columns.append(F.col(f.name))
    return rows.select(*columns)


def _matrix_query(report) -> Query:
    return lambda spark, folder: _flat(matrix_of(spark, folder).table(report))


for _report in REPORTS:
    QUERIES[f"matrix_{_report.name}"] = _matrix_query(_report)


@lru_cache(maxsize=4)
def _two_starts(spark: SparkSession, app: str, folder: str) -> Matrix:
    return Matrix(facts_of(spark, folder), [START, date(2024, 1, 2)], limit_seconds=LIMIT)


def _two_starts_query(name: str) -> Query:
    report = next(r for r in REPORTS if r.name == name)
    return lambda spark, folder: _flat(_two_starts(spark, spark.sparkContext.applicationId, folder).table(report))


QUERIES["matrix_two_starts"] = _two_starts_query("funnel_ordered")
QUERIES["matrix_two_starts_days"] = _two_starts_query("retention_days")


def _cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy(
        day_text("date_start").alias("date_start"), day_text("date_end").alias("date_end"),
        "usergroup", "category_id", "title",
    ).agg(F.count("result").alias("result_rows"))


def _report_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """The long result: number of rows in every cell of the matrix."""
    return _cells(matrix_of(spark, folder).rows())


QUERIES["report_matrix"] = _report_matrix
