"""Corner cases of scalars, sessions, funnels and cohorts on literal rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from footfall import names as N
from footfall.functions import scalars as S
from footfall.operators import distributions, facts, funnels, histories, overlaps, sessions
from footfall.plans.cohorts import COHORTS, CohortSpec, Did, cohort_events, members, register_views
from footfall.plans.templates import run_template

DAY = 86400


def values(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_json_text_and_key_presence(spark):
    rows = [('{"K": "1"}',), ('{"K": 1}',), ('{"K": null}',), ("{}",), ('{"K": true}',)]
    assert values(spark, "p string", rows, S.json_text(F.col("p"), "K")) == ["1", "1", None, None, "true"]
    absent = values(spark, "p string", rows, S.json_key_absent(F.col("p"), "K"))
    assert absent == [False, False, False, True, False]


def test_wider_london_box(spark):
    south, north, west, east = N.LONDON_BOX
    rows = [
        ("51.5", "0.0"), (str(south), "0.0"), (str(north), "0.0"), ("51.5", str(west)), ("51.5", str(east)),
        ("here", "0.0"), ("51.5", None), (" 51.5 ", "0"), ("NOLOCATION", "NOLOCATION"),
    ]
    got = values(spark, "a string, b string", rows, S.widen_london(F.col("a"), F.col("b"), F.lit("x")))
    assert got == ["London", "x", "x", "x", "x", "x", "x", "London", "x"]


def test_small_scalars(spark):
    rows = [("12",), (" 12 ",), ("12.5",), ("x",), (None,)]
    assert values(spark, "t string", rows, S.int_or_zero(F.col("t"))) == [12, 12, 0, 0, 0]
    rows = [("12.9",), ("-12.9",), ("7",), ("NaN",), ("1e30",), (None,)]
    assert values(spark, "t string", rows, S.whole_number(F.col("t"))) == [12, -12, 7, None, None, None]
    rows = [("true",), ("false",), ("odd",), (None,)]
    assert values(spark, "t string", rows, S.network_flag(F.col("t"))) == [True, False, True, True]
    rows = [(None,), ("",), ("NOLOCATION",), ("UNKNOWN",), ("Londonderry",), ("Paris",)]
    assert values(spark, "c string", rows, S.normalize_city(F.col("c"))) == [
        "NOLOCATION", "NOLOCATION", "NOLOCATION", "UNKNOWN", "London", "ROW"
    ]
    number = S.round_half_up(F.col("x"), 1).cast("string")
    assert values(spark, "x string", [("0.25",), ("-0.25",), ("0.35",)], number) == ["0.3", "-0.3", "0.4"]


def test_whole_days(spark):
    row = spark.sql("SELECT timestamp'2024-01-03 23:59:59' a, timestamp'2024-01-01 00:00:00' b").select(
        S.whole_days_between(F.col("a"), F.col("b")), S.micros_between(F.col("a"), F.col("b")),
        S.timestamp_text(F.col("a")), S.last_day_label(F.to_date("a")),
    ).first()
    assert tuple(row) == (2, 259199000000, "2024-01-03 23:59:59", date(2024, 1, 2))


def test_session_of_exactly_the_limit_is_dropped(make_log):
    log = make_log([
        {"session": 1, "at": 0}, {"session": 1, "at": 1800},
        {"session": 2, "at": 5000}, {"session": 2, "at": 6799},
        {"session": 3, "at": 9000}, {"session": 3, "at": 9000 + 5000, "event": "MapModeEnd"},
    ])
    kept = {r.session: (r.duration_us, r.active_day) for r in sessions.session_times(log).collect()}
    assert kept == {2: (1799000000, 1), 3: (0, 1)}


ADD, VIEW, FINAL = "ItineraryAdd", "ButtonPressToItinerary", "TransitListInfoOpen"


def funnel(make_log, *steps):
    return tuple(funnels.ordered_funnel_report(make_log([{"event": e, "at": t} for e, t in steps])).first())


def test_two_adds_at_the_same_time_count(make_log):
    assert funnel(make_log, (ADD, 5), (ADD, 5), (VIEW, 1), (FINAL, 6)) == (1, 1)
    assert funnel(make_log, (ADD, 5), (VIEW, 1), (FINAL, 6)) == (None, None)


def test_final_at_completion_time_does_not_count(make_log):
    assert funnel(make_log, (ADD, 5), (ADD, 7), (VIEW, 9), (FINAL, 9)) == (1, None)
    assert funnel(make_log, (ADD, 5), (ADD, 7), (VIEW, 9), (FINAL, 9), (FINAL, 10)) == (1, 1)


def test_empty_cohort(make_log):
    empty = make_log([{}]).where("false")
    assert funnels.unique_users_report(empty).first()[0] == 0
    assert funnels.acquisition_report(empty).first()[0] == 0
    assert tuple(funnels.ordered_funnel_report(empty).first()) == (None, None)
    assert tuple(funnels.offline_then_online_report(empty).first()) == (None, None)
    assert funnels.final_frequency_report(empty).first().boxplot is None
    steps = funnels.step_conversion_report(empty).collect()
    assert [(r.users, r.pct_of_previous) for r in steps] == [(0, None), (0, None), (0, None)]


def test_offline_then_online_needs_a_later_event(make_log):
    log = make_log([
        {"userid": "a", "event": "MapIteraction", "network": False, "at": 5}, {"userid": "a", "at": 5},
        {"userid": "b", "event": "MapIteraction", "network": False, "at": 5}, {"userid": "b", "at": 6},
        {"userid": "c", "event": "MapIteraction", "network": None, "at": 5},
    ])
    assert tuple(funnels.offline_then_online_report(log).first()) == (2, 1)


def test_null_add_source(make_log):
    log = make_log([
        {"event": "ItineraryAdd2", "properties": p}
        for p in ('{"WNItineraryChangeButton": "0"}', "{}", "{}")
    ])
    share = {r.addfrom: float(r.percentage) for r in distributions.add_source_share(log).collect()}
    assert share == {"0": 100.0, None: 0.0}
    with_source = log.withColumn("it_add_from", S.json_text(F.col("properties"), N.KEY_ADD_SOURCE))
    counts = {r.it_add_from: r.num_of_pluses for r in distributions.add_source_report(with_source).collect()}
    assert counts == {"0": 1, None: 2}


def test_null_id_in_not_in_list(spark):
    got = spark.createDataFrame([("a",), ("b",)], "userid string")
    flagged = spark.createDataFrame([("b",), (None,)], "userid string")
    run = lambda aware: overlaps.got_value_not_experimental(flagged, got, got, aware).collect()
    assert [r.userid for r in run(False)] == ["a"]
    assert run(True) == []


def test_overlap_keeps_multiplicity(spark):
    flagged = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "userid string, session int")
    got = spark.createDataFrame([("a",), ("a",), ("a",)], "userid string")
    cohort = spark.createDataFrame([("a",), ("b",)], "userid string")
    out = overlaps.experimental_and_got_value(flagged, got, cohort).collect()
    assert [tuple(r) for r in out] == [("a", 6)]


def test_unknown_places(make_log):
    log = make_log([{"userid": u, "city": c} for u, c in (("a", "UNKNOWN"), ("b", None), ("c", "Paris"))])
    assert {r.userid for r in facts.never_located_users(log).collect()} == {"a"}
    assert {r.userid for r in facts.never_located_users(log, True).collect()} == {"a", "b"}


def test_map_flags(make_log):
    log = make_log([
        {"userid": "a", "event": "MapModeStart"}, {"userid": "b", "event": "DetailsMapOpen"},
        {"userid": "c", "event": "TransitModeFromItinerary"}, {"userid": "d"},
    ])
    use = distributions.map_use(log)
    cells = {tuple(r)[:4]: float(r.pct) for r in distributions.map_flag_combinations(use).collect()}
    # c views transit more often than the map and is left out
    assert cells == {(True, False, False, 1): 33.33, (False, False, True, 1): 33.33, (False, False, False, 1): 33.33}
    cities = facts.first_cities(log)
    assert distributions.map_viewers_report(use, cities).first()[0] == 1
    assert distributions.map_viewers_who(log, use, cities, "MapModeStart").count() == 1


@pytest.fixture()
def travellers(spark, make_log):
    """a: London. b: Paris, London later. c: Paris only. d: joined before the window."""
    start = {"event": "AppStartup"}
    log = make_log([
        {"userid": "a", "at": 10, **start},
        {"userid": "a", "at": 20, "properties": '{"WNAppVariant": "1", "WNAppVariantBranchFirstAddJumpsToItin": null}'},
        {"userid": "b", "at": 10, "city": "Paris", **start}, {"userid": "b", "at": 40 * DAY, "city": "LONDON"},
        {"userid": "c", "at": 10, "city": "Paris", "properties": '{"WNAppVariant": "1"}', **start},
        {"userid": "d", "at": -DAY, **start}, {"userid": "d", "at": 30},
    ])
    got = spark.createDataFrame([("c",)], "userid string").select("userid", F.lit("2024-01-02").cast("timestamp").alias("created_at"))
    flagged = spark.createDataFrame([("a", 1)], "userid string, session int")
    return facts.Facts(log).with_detections(got, flagged)


def who(travellers, spec):
    spec = COHORTS.get(spec, spec)
    return {r.userid for r in members(travellers, spec, date(2024, 1, 1), date(2024, 1, 8)).collect()}


def test_cohort_members(travellers):
    assert who(travellers, "first_time_londoners") == {"a"}
    assert who(travellers, "first_time_row") == {"b", "c"}
    # being in London counts after the window's end too
    assert who(travellers, "first_time_row_lnd") == {"b"}
    assert who(travellers, "first_time_row_nolnd") == {"c"}
    assert who(travellers, "first_time_row_gotvalue") == {"c"}
    # an explicit null is a branch
    assert who(travellers, "first_time_londoners_variant_1") == {"a"}
    assert who(travellers, "first_time_londoners_variant_1_branch_undefined") == set()


def test_own_cohort_and_views(travellers, spark):
    own = CohortSpec("paris_variant", "", False, did=Did("get_json_object(properties, '$.WNAppVariant') = '1'"))
    assert who(travellers, own) == {"c"}
    window = (date(2024, 1, 1), date(2024, 1, 8))
    assert cohort_events(travellers, "first_time_londoners_noexp", *window).count() == 0
    register_views(travellers, *window, names=["first_time_row"])
    out = run_template(
        spark, "SELECT count(*) n FROM IDENTIFIER(:view) WHERE event = :event", "first_time_row", event="AppStartup"
    )
    assert out.first().n == 2


def test_samples(travellers):
    events = travellers.logs
    assert histories.sample_users(events, 2, seed=1).distinct().count() == 2
    assert histories.sample_users(events, 100).count() == 4
    assert histories.sample_users(events, 100, by="event").count() == 7
    assert histories.histories(events, events.where("userid = 'b'")).columns == list(N.HISTORY_FIELDS)
