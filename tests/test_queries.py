"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
from compare import compare

import __spark_entry__ as entry_points
from tablewright.queries import ORACLES, QUERIES


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["kind", "parent", "n", "name"] and df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    problem = compare(spark, name, "/root/testdata/sf0.001")
    assert problem is None, problem
