"""Every query that has a SQL twin gives the same rows on DuckDB; the others give rows."""

import pytest
from compare import TESTDATA, compare

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# The sweep over 350 settings and the comparisons are run by the tests of the operators.
SLOW = {"j17_grid_search", "j19_full_comparison", "j19_weekly_comparison"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, name):
    ok, message, _ = compare(spark, f"{TESTDATA}/sf0.001", name, QUERIES[name], SQL.get(name))
    assert ok, message


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)
