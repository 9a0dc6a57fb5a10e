"""Every registered query against its DuckDB twin, by value."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle import oracle_sql
from roadpulse.plans.catalog import queries
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_matches(spark, con, sf, name):
    assert compare(spark, con, name, sf) is None


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "vehicles_per_km" in df.columns
