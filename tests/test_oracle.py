"""Every query against its comparison SQL, and its plan against what must not be in it."""

import duckdb
import pytest

import __spark_entry__ as entry
import check
from conftest import DATA
from matchboard.catalog import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = entry.queries()[name](spark, DATA)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name != "rate_limit":
        assert not any(step in plan for step in ("Python", "InPandas", "InArrow"))
    got = result.toArrow()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got.num_rows > 0
        return
    expected = duck.execute(sql).to_arrow_table()
    assert check.shape(got) == check.shape(expected)
    assert check.rows(got) == check.rows(expected)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
