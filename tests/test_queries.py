"""Every registered query against its oracle SQL, on the smallest tables."""

import os

import __spark_entry__ as contract
import pytest
from oracle import compare, duck

from clickloom.plans.clickstream import QUERIES
from clickloom.plans.oracle import ORACLES as SQL

pytestmark = pytest.mark.skipif(
    not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here"
)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_oracle(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
