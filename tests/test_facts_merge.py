"""Facts kept up to date load by load equal facts rebuilt from the whole log."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from footfall import names as N
from footfall.operators import histories
from footfall.operators.facts import first_cities, first_time_users
from footfall.sinks import tables


def random_log(make_log, n, seed):
    rng = random.Random(seed)
    return make_log([
        {
            "userid": f"u{rng.randrange(200)}", "event": rng.choice(["AppStartup", "X", "Y"]), "at": rng.randrange(6 * 86400),
            "session": rng.randrange(1, 4), "city": rng.choice(["London", "Paris", None, N.UNKNOWN, N.NO_LOCATION]), "event_id": i,
        }
        for i in range(n)
    ])


def stored_facts(spark, folder):
    users, cities = tables.read_merged_facts(spark, folder)
    return {tuple(r) for r in users.collect()}, {tuple(r) for r in cities.collect()}


def rebuilt(log):
    return {tuple(r) for r in first_time_users(log).collect()}, {tuple(r) for r in first_cities(log).collect()}


def test_three_loads_in_any_order_equal_a_rebuild(spark, make_log, tmp_path):
    log = random_log(make_log, 1500, 1).cache()
    folder = str(tmp_path / "facts")
    loads = [log.where(F.dayofmonth("created_at").between(a, a + 1)) for a in (3, 1, 5)]
    for k, load in enumerate(loads):
        tables.merge_facts(load, folder)
        if k == 1:
            tables.merge_facts(load, folder)  # a load that comes twice changes nothing
    assert stored_facts(spark, folder) == rebuilt(log)
    tables.merge_facts(log.limit(0), folder)
    assert stored_facts(spark, folder) == rebuilt(log)


def test_a_merge_rewrites_only_the_buckets_it_touches(spark, make_log, tmp_path):
    log = random_log(make_log, 1500, 2)
    folder = str(tmp_path / "facts")
    tables.merge_facts(log, folder)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "facts" / "facts").rglob("*.parquet")}
    one = make_log([{"userid": "u7", "event": "AppStartup", "at": -86400, "city": "Rome", "event_id": -1}])
    tables.merge_facts(one, folder)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "facts" / "facts").rglob("*.parquet")}
    same = {p for p in files if after.get(p) == files[p]}
    assert len(files) > 30 and len(files) - len(same) == 1
    assert stored_facts(spark, folder) == rebuilt(log.unionByName(one))


def test_weighted_sample_follows_the_weights(make_log):
    """A user with half of all events comes out nearly always, one with a thousandth hardly ever."""
    log = make_log([{"userid": "heavy" if i % 2 else f"u{i % 500}"} for i in range(1000)]).cache()
    drawn = [{r.userid for r in histories.sample_users(log, 20, seed=s, by="weight").collect()} for s in range(12)]
    assert all(len(d) == 20 for d in drawn) and sum("heavy" in d for d in drawn) >= 11
    assert sum("u4" in d for d in drawn) <= 4 and len(set(map(frozenset, drawn))) == 12
    again = histories.sample_users(log.repartition(7), 20, seed=3, by="weight")
    assert {r.userid for r in again.collect()} == drawn[3]
