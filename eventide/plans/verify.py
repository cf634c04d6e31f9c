"""Compare a registered Spark query with its DuckDB oracle (rows, columns, values)."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if glob.glob(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm_value(v):
    if v is None or (isinstance(v, float) and pd.isna(v)):
        return None
    if v is pd.NaT:
        return None
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm_value(v.item())
    return v


def normalise(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm_value(r[c]) for c in cols) for r in df[cols].to_dict("records")]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from eventide.plans.catalog import QUERIES
    from eventide.plans.oracle import ORACLE
    con = con or duckdb_connection(sf_dir)
    sdf = QUERIES[name](spark, sf_dir)
    s_rows = [r.asDict() for r in sdf.collect()]
    s_pd = pd.DataFrame(s_rows, columns=sdf.columns)
    o_pd = con.execute(ORACLE[name]).fetchdf()
    res = {"name": name, "spark_rows": len(s_pd), "oracle_rows": len(o_pd),
           "columns_match": sorted(s_pd.columns) == sorted(o_pd.columns)}
    if res["columns_match"]:
        a, b = normalise(s_pd), normalise(o_pd)
        res["values_match"] = a == b
        if not res["values_match"]:
            sa, sb = set(a), set(b)
            res["only_spark"] = sorted(sa - sb, key=str)[:3]
            res["only_oracle"] = sorted(sb - sa, key=str)[:3]
    else:
        res["values_match"] = False
        res["spark_cols"], res["oracle_cols"] = list(s_pd.columns), list(o_pd.columns)
    return res
