"""The sparse log tells the cohorts apart: a condition that is left out shows."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest

from checks.queries import sparse_facts
from footfall.plans.cohorts import COHORTS, members

FOLDER = "/root/testdata/sf0.01"
START, END = date(2024, 1, 1), date(2024, 1, 31)


@pytest.fixture(scope="module")
def users(spark):
    facts = sparse_facts(spark, FOLDER)
    return facts, {n: frozenset(r.userid for r in members(facts, c, START, END).collect()) for n, c in COHORTS.items() if not c.drop_experimental}


def test_cohorts_differ_and_none_is_empty(users):
    _, found = users
    assert len(set(found.values())) == len(found) and all(found.values())


@pytest.mark.parametrize("name", [n for n, c in COHORTS.items() if c.did or c.did_not or c.got_value])
def test_a_dropped_condition_shows(users, name):
    facts, found = users
    bare = replace(COHORTS[name], did=None, did_not=None, got_value=False)
    assert found[name] < {r.userid for r in members(facts, bare, START, END).collect()}
    if COHORTS[name].did and " AND " in COHORTS[name].did.condition:
        part = replace(COHORTS[name], did=replace(COHORTS[name].did, condition=COHORTS[name].did.condition.split(" AND ")[0]))
        assert found[name] < {r.userid for r in members(facts, part, START, END).collect()}
