"""Every named query against its SQL in DuckDB, on whole tables."""

import pytest

import __spark_entry__ as contract
from roadpulse.plans.oracles import ORACLES
from roadpulse.plans.queries import QUERIES
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    problem = difference(spark, duck, SF_DIR, contract.queries()[name],
                         contract.oracle_sql()[name])
    assert problem is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
