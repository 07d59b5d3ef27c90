"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import os

import pytest

import registry
from compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RUNS, SQL = registry.all_queries(), registry.all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    assert difference(spark, SF_DIR, RUNS[name], SQL[name], duck) is None


@pytest.mark.parametrize("name", sorted(set(RUNS) - set(SQL)))
def test_query_gives_rows(spark, name):
    assert not RUNS[name](spark, SF_DIR).isEmpty()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(RUNS)
