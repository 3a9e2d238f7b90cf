"""Spark-vs-DuckDB comparison in the spirit of the driver's correctness gate:
row count, column names, and order-insensitive exact values."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), repr(x)) for x in row)


def compare(spark_df, con, sql: str) -> dict:
    srows = [tuple(r) for r in spark_df.collect()]
    scols = list(spark_df.columns)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"spark_rows": len(srows), "oracle_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols), "spark_cols": scols, "oracle_cols": dcols}
    if not out["cols_match"]:
        out["ok"] = False
        return out
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    s = sorted((tuple(_norm(x) for x in r) for r in srows), key=_key)
    d = sorted((tuple(_norm(x) for x in r) for r in drows), key=_key)
    diffs = [(a, b) for a, b in zip(s, d) if a != b]
    out["value_diffs"] = len(diffs) + abs(len(s) - len(d))
    out["examples"] = diffs[:3]
    out["ok"] = out["value_diffs"] == 0 and len(s) == len(d)
    return out
