"""The registered queries that have a DuckDB twin equal it on the smallest tables."""

import pytest

import __spark_entry__ as E
from orderflow.llm.queries import ORACLE, QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, name):
    assert compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)["ok"]


def test_one_query_per_operator_and_the_pipeline():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
