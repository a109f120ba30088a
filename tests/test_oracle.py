import os

import pytest
from oracle_check import compare, connect, contract

from gaugeflow.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("GAUGEFLOW_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
