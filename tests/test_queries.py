"""Every registered query against its SQL equivalent, on the given tables."""

import os

import pytest

import __spark_entry__ as contract
import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert oracle.difference(df, db, contract.oracle_sql()[name]) is None


def test_every_query_has_an_oracle():
    assert contract.QUERIES.keys() == contract.ORACLES.keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
