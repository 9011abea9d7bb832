"""Every registered query against its SQL, and the driver contract."""

import pytest
from conftest import SMALL

import oracle
from passagecraft.oracles import ORACLES
from passagecraft.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    count, extra, missing = oracle.differences(QUERIES[name](spark, SMALL), con, ORACLES[name])
    assert count and not extra and not missing


def test_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
