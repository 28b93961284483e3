"""Every registered query against its SQL, on the smallest data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    found = QUERIES[name](spark, SF_DIR).toArrow()
    if name in ORACLES:
        problem = compare(found, con.sql(ORACLES[name]).to_arrow_table())
        assert problem is None, problem
    else:
        assert found.num_rows > 0


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry(spark).collect()
    assert {r["l_returnflag"] for r in rows} == {"A", "N", "R"}
    assert all(0 < r["n_above_mean"] < r["n_items"] for r in rows)
