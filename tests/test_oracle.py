"""Every registered query against its oracle SQL, and the shape of the entry file."""

import os

import compare
import pytest

import __spark_entry__ as entry_file
from slotstream.checks import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    connection = compare.connect(SF)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_file.queries())
    assert set(ORACLES) <= set(entry_file.oracle_sql())


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert compare.differences(df, con, ORACLES[name]) is None
