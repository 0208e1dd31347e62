"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from annalist.plans import registry
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    assert compare(contract.queries()[name](spark, SF), con, ORACLES[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
