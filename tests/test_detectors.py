"""Window forms against plain folds over random histories, split and whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from footfall import names as N
from footfall.operators import detectors, offline
from footfall.plans.skew import add_slice, find_hot
from tests import folds

EVENTS = (
    "MapIteraction", "ItineraryAdd", "ItineraryRemove", "DetailsChecked", "AppStartup",
    "ItineraryAdd2", "DetailsMapOpen",
)
CITIES = ("London", "Paris", "UNKNOWN", "NOLOCATION", None)


def random_rows(seed, users, interleave):
    rnd, rows = random.Random(seed), []
    for u in range(users):
        at, session, offline_now = 0, 1, False
        for _ in range(rnd.randint(1, 90)):
            at += rnd.choice((0, 1, 3, 20, 90, 300, 4000))
            if interleave:
                session = rnd.randint(1, 5) if rnd.random() < 0.5 else session
            elif rnd.random() < 0.1:
                session += 1
            if rnd.random() < 0.15:
                offline_now = not offline_now
            network = None if rnd.random() < 0.03 else not offline_now
            poi = rnd.choice((0, 2, 11)) if rnd.random() < 0.05 else 1
            rows.append({
                "userid": f"u{u}", "at": at, "activation_time": at + rnd.randint(-5, 5) * (rnd.random() < 0.2),
                "session": session, "network": network,
                "event": rnd.choices(EVENTS, (1, 4, 3, 2, 1, 1, 1) if interleave else (1,) * 7)[0],
                "city": rnd.choices(CITIES, (1, 1, 4, 4, 4))[0], "poi": poi,
                "properties": json.dumps({N.KEY_COUNT: str(poi)}), "event_id": len(rows),
            })
    return rows


def per_user(rows):
    users = {}
    for r in rows:
        users.setdefault(r["userid"], []).append(r)
    return users


@pytest.fixture(scope="module", params=["whole", "split"])
def case(request, spark, make_log):
    """Random rows as a log, once as it is and once with most users cut into slices."""

    def build(seed, interleave=False):
        rows = random_rows(seed, 150, interleave)
        log = make_log(rows)
        hot = None
        if request.param == "split":
            hot = find_hot(log, "userid", "created_at", max_rows=12, unit_seconds=30)
            assert hot.cuts.agg(F.max(F.size("cuts"))).first()[0] > 3
        return rows, add_slice(log, hot).cache(), hot is not None

    return build


def test_got_value(case):
    rows, log, sliced = case(1)
    hits = detectors.got_value_hits(log, sliced=sliced)
    mine = hits.groupBy("userid").agg(
        F.min_by("event_id", F.struct("created_at", "activation_time", "event_id")).alias("e")
    )
    expected = {u: folds.got_value(h) for u, h in per_user(rows).items()}
    expected = {u: e for u, e in expected.items() if e is not None}
    assert {r.userid: r.e for r in mine.collect()} == expected
    assert 20 < len(expected) < 150


@pytest.mark.parametrize("compat", [False, True])
def test_closest_location(case, spark, compat):
    rows, log, sliced = case(2)
    table = spark.createDataFrame([("nowhere", "ROW")], "city string, region string")
    mine = detectors.closest_location(log, table, compat, sliced)
    expected = {}
    for h in per_user(rows).values():
        expected |= folds.closest(h, compat)
    assert {r.event_id: r.location for r in mine.collect()} == expected


def flags_of(rows):
    return {(u, s) for u, h in per_user(rows).items() for s in folds.experimental(h)}


def test_experimental_sessions(case):
    rows, log, sliced = case(3)
    mine = detectors.experimental_sessions(log, sliced=sliced)
    assert {tuple(r) for r in mine.collect()} == flags_of(rows)


def test_experimental_sessions_in_strict_order(case):
    rows, log, sliced = case(4, interleave=True)
    expected = flags_of(rows)
    simple = {tuple(r) for r in detectors.experimental_sessions(log, sliced=sliced).collect()}
    assert simple != expected  # sessions interleave, so order matters here
    strict = detectors.experimental_sessions(log, strict_order=True, sliced=sliced)
    assert {tuple(r) for r in strict.collect()} == expected


def test_strict_order_changes_nothing_without_interleaving(case):
    rows, log, sliced = case(5)
    strict = detectors.experimental_sessions(log, strict_order=True, sliced=sliced)
    assert {tuple(r) for r in strict.collect()} == flags_of(rows)


def test_offline_runs(case):
    rows, log, sliced = case(6)
    runs = offline.offline_runs(log, sliced=sliced).select(
        "userid", F.unix_seconds("started").alias("s"), "offline_times"
    )
    mine = {}
    for r in runs.collect():
        mine.setdefault(r.userid, []).append((r.s - 1704067200, r.offline_times))
    expected = {u: folds.offline_runs(h, N.RETENTION_RUN_EXCLUDED) for u, h in per_user(rows).items()}
    assert {u: sorted(v) for u, v in mine.items()} == {u: v for u, v in expected.items() if v}


def test_batches_cut_histories_and_first_hit_wins(case, spark):
    rows, log, sliced = case(7)
    table = spark.createDataFrame([("nowhere", "ROW")], "city string, region string")
    got, flagged = detectors.detect(log, table, "2024-01-01", "2024-01-03", days=1, sliced=sliced)
    expected_got, expected_flags = {}, set()
    for u, h in per_user(rows).items():
        for day in range(2):
            batch = [e for e in h if e["at"] // 86400 == day]
            hit = folds.got_value(batch)
            if hit is not None and u not in expected_got:
                at = next(e["activation_time"] for e in batch if e["event_id"] == hit)
                expected_got[u] = (at, folds.closest(batch, False)[hit])
            expected_flags |= {(u, s) for s in folds.experimental(batch)}
    assert {r.userid: (r.activation_time, r.city) for r in got.collect()} == expected_got
    assert {tuple(r) for r in flagged.collect()} == expected_flags


def run_of(make_log, *events):
    return detectors.got_value_hits(make_log(list(events))).count()


def off(at, event="X", network=False):
    return {"at": at, "event": event, "network": network}


def test_map_interaction_needs_no_five_events(make_log):
    assert run_of(make_log, off(0), off(1), off(2), off(600, "MapIteraction")) == 1
    assert run_of(make_log, off(0), off(1), off(2), off(600)) == 0


def test_run_must_last_ten_minutes(make_log):
    assert run_of(make_log, off(0), off(1), off(2), off(3), off(599)) == 0
    assert run_of(make_log, off(0), off(1), off(2), off(3), off(600)) == 1


def test_excluded_event_does_not_end_a_run(make_log):
    rows = [off(0), off(1), off(2, "AppStartup", True), off(3), off(4), off(600)]
    assert run_of(make_log, *rows) == 1
    rows[2] = off(2, "X", True)
    assert run_of(make_log, *rows) == 0


def test_null_network_ends_a_run(make_log):
    log = make_log([off(0), off(1, network=None), off(2)])
    assert offline.offline_runs(log).count() == 2


def test_interleaved_sessions_with_the_first_flagged(make_log):
    add = {"event": "ItineraryAdd"}
    rows = [{"session": s, "at": i, **add} for i, s in enumerate((1, 1, 1, 2, 1, 2, 1, 2))]
    log = make_log(rows)
    assert {r.session for r in detectors.experimental_sessions(log).collect()} == {1}
    strict = detectors.experimental_sessions(log, strict_order=True)
    assert {r.session for r in strict.collect()} == {1, 2}


def test_closest_place_and_compat(make_log, spark):
    rows = [{"at": 0, "city": "Paris"}, {"at": 10, "city": None}, {"at": 13, "city": "London"}]
    table = spark.createDataFrame([("Paris", "ROW"), ("London", "London")], "city string, region string")
    log = make_log(rows)
    middle = [
        detectors.closest_location(log, table, compat).where("event_id = 1").first().location
        for compat in (False, True)
    ]
    assert middle == ["London", "ROW"]


def interleaved_rows(n_sessions, n_events, seed):
    rng = random.Random(seed)
    rows, at, session = [], 0, 0
    for i in range(n_events):
        at += rng.choice((1, 4, 9, 15, 60))
        session = rng.randrange(n_sessions) if rng.random() < 0.3 else session
        event = rng.choice(["ItineraryAdd", "ItineraryRemove", "DetailsChecked", "X", "X", "X"])
        rows.append({
            "userid": "u", "event": event, "at": at, "activation_time": at, "session": session, "network": True,
            "poi": 11 if rng.random() < 0.004 else 1, "event_id": i,
        })
    return [r | {"properties": json.dumps({N.KEY_COUNT: str(r["poi"])})} for r in rows]


@pytest.mark.parametrize("split", [False, True])
def test_two_hundred_interleaved_sessions_of_one_user(make_log, split):
    """One tangle of 200 sessions, whole and in slices: flagged as by the plain fold."""
    rows = interleaved_rows(200, 3000, 3)
    log = make_log(rows)
    hot = find_hot(log, "userid", "created_at", max_rows=100) if split else None
    strict = detectors.experimental_sessions(add_slice(log, hot), strict_order=True, sliced=split)
    flagged = {r.session for r in strict.collect()}
    assert flagged == folds.experimental(rows) and 20 < len(flagged) < 200


def test_strict_order_takes_a_fixed_number_of_jobs(spark, make_log):
    """As many jobs for a tangle of 150 sessions as for one of three."""

    def jobs(rows):
        tracker, group = spark.sparkContext.statusTracker(), f"strict {len(rows)}"
        spark.sparkContext.setJobGroup(group, group)
        detectors.experimental_sessions(make_log(rows), strict_order=True).collect()
        return len(tracker.getJobIdsForGroup(group))

    try:
        few, many = jobs(interleaved_rows(3, 300, 1)), jobs(interleaved_rows(150, 1500, 2))
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert abs(few - many) <= 2  # the planner may merge a small exchange


def test_facts_pass_the_way_of_detection_on(case, spark):
    from datetime import date

    from footfall.operators.facts import Detection, Facts

    rows, log, _ = case(8, interleave=True)
    table = spark.createDataFrame([("nowhere", "ROW")], "city string, region string")
    facts = Facts(log, None, table)
    strict = facts.detected(Detection(strict_order=True))
    assert {tuple(r) for r in strict.experimental.collect()} == flags_of(rows)
    daily = facts.detected(Detection(date(2024, 1, 1), date(2024, 1, 3), 1, strict_order=True))
    expected = set()
    for u, h in per_user(rows).items():
        for day in range(2):
            expected |= {(u, s) for s in folds.experimental([e for e in h if e["at"] // 86400 == day])}
    assert {tuple(r) for r in daily.experimental.collect()} == expected
    assert {tuple(r) for r in facts.experimental.collect()} != flags_of(rows)
