"""Every registered query equals its DuckDB oracle (the driver's gate, at sf0.001)."""

import os

import pytest

from eventide.plans.catalog import QUERIES
from eventide.plans.oracle import ORACLE
from eventide.plans.verify import compare, duckdb_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    return duckdb_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r["columns_match"], r
    assert r["values_match"], r
