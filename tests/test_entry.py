"""The driver contract in __spark_entry__.py."""

import os

import pytest

import __spark_entry__ as E
from eventide.plans.catalog import QUERIES


def test_queries_and_oracles_pair_up():
    q, o = E.queries(), E.oracle_sql()
    own = set(QUERIES)      # the training-data queries come on top, where their folder is present
    assert len(own) == 56 and own <= set(q) and own <= set(o) and set(o) <= set(q)
    assert all(callable(f) for f in q.values())


def test_entry_smoke(spark):
    if not os.path.isdir(E.SMOKE_DIR):
        pytest.skip("test data not present")
    df = E.entry(spark)
    assert df.columns == ["item_id", "window_end", "cnt", "rank"]
    assert df.count() > 0
