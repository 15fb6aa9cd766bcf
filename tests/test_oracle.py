"""Every registered query against its DuckDB oracle on the smallest tables
(the driver's own check runs the same at sf0.01)."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = E._q.queries()
SQL = E._q.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name], SQL.get(name), SF, con)
    plan = res.pop("_plan")
    assert res["status"] in ("OK", "rows-only"), res
    # no pairs, no funnel into one task
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert node not in plan, (name, node)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["table_name", "row_key", "family", "qualifier", "ts", "value", "n_combined", "n_rejected"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
