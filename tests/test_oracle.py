"""Every registered query against its SQL, whole results, on the same tables."""

from __future__ import annotations

import pytest
from conftest import TESTDATA

import __spark_entry__ as entry_points
from salesmart.plans.registry import QUERIES
from compare import connect, difference

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql()) and set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    problem, rows, _, _ = difference(
        spark, con, entry_points.queries()[name], entry_points.oracle_sql()[name], SF_DIR
    )
    assert problem is None, problem
    assert rows > 0 or name in {"anomaly_monitor", "top_anomaly_stores"}


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).count() > 0
