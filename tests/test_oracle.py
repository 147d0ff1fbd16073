"""Every registered query against its SQL, on the small sample tables."""

import os

import pytest

import __spark_entry__ as entry_points
from compare import connect, difference
from fleetlens.plans.catalog import QUERIES

SF = os.environ.get("FLEETLENS_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_same_rows(spark, con, name):
    df = entry_points.queries()[name](spark, SF)
    assert difference(df, con, entry_points.oracle_sql()[name]) == []
