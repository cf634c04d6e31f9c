"""Registered queries whose rows SQL can express, against DuckDB on a whole table."""

import duckdb
import pytest

from eventide.llm.oracle import ORACLE
from eventide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, got.select(names).collect()), key=key) == sorted(want.fetchall(), key=key)


def test_every_operator_is_registered(spark):
    import __spark_entry__
    names = __spark_entry__.queries().keys()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == [] and "pipeline" in names
