"""The queries of the subpackage against their SQL on the smallest tables, and their registration."""

import pytest

import __spark_entry__ as contract
from annalist.llm import queries
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, con, name):
    assert compare(contract.queries()[name](spark, SF), con, queries.ORACLES[name]) == ""


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert "pipeline" in contract.queries()
