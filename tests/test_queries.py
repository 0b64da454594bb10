"""Every registered query beside its SQL, on the smallest tables."""

import pytest
from check_oracles import compare, connect

import __spark_entry__ as contract
from twinloom.plans.oracles import ORACLES
from twinloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_gives_what_its_sql_gives(spark, sf_dir, connection, name):
    assert compare(QUERIES[name](spark, sf_dir), connection.execute(ORACLES[name])) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0 and "occurred_at" in result.columns
