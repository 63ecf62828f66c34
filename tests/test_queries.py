"""Registered queries against their SQL on the smallest tables. Long ones are left to check_queries.py."""

import os

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect

SF = "/root/testdata/sf0.001"
LONG = ("m14_", "m16_", "c7_", "q1_", "q2_", "q3_", "g11_", "m11_", "m12_", "g15_", "c5_", "c6_", "u4_", "m7_", "m8_", "w7_")
SQL = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in SQL if not n.startswith(LONG)])
def test_query_equals_sql(spark, con, name):
    rows, problem = compare(spark, con, name, entry.queries()[name], SQL[name], SF)
    assert problem is None


def test_every_sql_has_a_query_and_the_flagship_runs(spark):
    assert set(SQL) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
