"""Every registered query against its SQL, on the smallest data."""

from pathlib import Path

import pytest
from oracle import compare, connect

import __spark_entry__ as driver
from punctua.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    ok, message = compare(spark, duck, FOLDER, name)
    assert ok, message
