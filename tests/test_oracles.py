"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from cairn.plans import registry
from tests.oracle_compare import compare, duck_connection

SF_DIR = os.environ.get("CAIRN_TEST_SF", "/root/testdata/sf0.001")
QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_DIR)


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLES), set(QUERIES) ^ set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "CUSTOMER_ID"
