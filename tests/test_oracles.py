"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry_points
from viewpulse.plans.oracles import all_oracles
from viewpulse.plans.queries import all_queries

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert compare.differences(QUERIES[name](spark, SF), duck, ORACLES[name]) == []


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_recent_viewers_are_not_compared_with_nothing(spark, sf):
    assert QUERIES["live_recent_viewers"](spark, f"/root/testdata/{sf}").count() > 0
