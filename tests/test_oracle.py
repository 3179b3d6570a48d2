"""Every registered query equals its DuckDB twin on the smallest scale."""

import pytest

import __spark_entry__ as E
from orderflow.plans.catalog import QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert res["ok"] in (True, None), res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 4 and df.columns == ["shard", "rows", "avg_amount"]

