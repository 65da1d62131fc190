"""Every catalogue query against its DuckDB oracle on the smallest driver
tables (the driver repeats this at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_catalogue_query_has_an_oracle():
    """The training-data operators that SQL cannot express have brute-force tests of their own."""
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert res["ok"], res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "goals_per_match" in df.columns
