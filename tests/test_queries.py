"""All registered queries next to their statements, on the smallest test tables."""

import importlib
import os

import pytest

from checks import compare, queries

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF)


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, connection, name):
    assert compare.compare(spark, connection, SF, name) == []


def test_entry_points(spark):
    driver = importlib.import_module("__spark_entry__")
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() > 0
