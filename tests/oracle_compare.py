"""Compare a Spark query with its DuckDB oracle (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    # Doubles are compared exactly: both sides round the same way, so any
    # value hash over the results agrees.
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), repr(x)) for x in row)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = spark_df.collect()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    if sorted(s_cols) != sorted(d_cols):
        out["ok"] = False
        out["error"] = f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    out["ok"] = len(a) == len(b) and not diffs
    if diffs:
        out["first_diff"] = (order, diffs[0])
        out["n_diffs"] = len(diffs)
    return out
