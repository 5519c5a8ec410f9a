"""Every registered query against its SQL, bit for bit."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import assert_same, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    text = entry.oracle_sql().get(name)
    if text is None:
        assert df.count() >= 0
    else:
        assert assert_same(df, con, text) >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
