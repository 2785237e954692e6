"""Every registered query against its SQL, and properties of all plans."""

import pytest

import __spark_entry__ as entry
from galecast.catalog import QUERIES
from galecast.oracle import ORACLE
from oracle_check import SF_ROOT, compare, connect

SF = f"{SF_ROOT}/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, connection, ORACLE[name]) == ""
    text = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("Python", "CartesianProduct", "NestedLoopJoin", "InMemoryTableScan"):
        assert costly not in text


def test_entry(spark):
    assert len(entry.entry(spark).collect()) == 10


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


def test_all_registered_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
