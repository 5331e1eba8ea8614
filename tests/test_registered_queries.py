"""Every registered query against its reference SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, duck_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["category_name", "net_revenue"]
    assert df.count() > 0


# The optional corpus queries have tests of their own.
NAMES = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(entry.oracle_sql()) - set(entry.LLM_ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_matches_reference_sql(spark, con, name):
    got = spark_rows(entry.queries()[name](spark, SF_DIR))
    want = duck_rows(con, entry.oracle_sql()[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
