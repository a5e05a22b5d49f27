"""Spark result vs DuckDB oracle: row count, column names, order-insensitive values."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

# decimals kept when comparing doubles; both sides already round to 9, so
# BASKETRY_EXACT=1 compares them exactly as a value hash would
DECIMALS = None if os.environ.get("BASKETRY_EXACT") == "1" else 6

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.isdir(p):
            p += "/*.parquet"
        if os.path.exists(p.removesuffix("/*.parquet")):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if hasattr(v, "item") and not isinstance(v, (list, tuple, str, bytes)):
        try:
            v = v.item()
        except (ValueError, AttributeError):
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if DECIMALS is None else round(v, DECIMALS)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    return v


def rows_of(pdf, cols):
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, sql: str, sf_dir: str) -> tuple[bool, str]:
    sp = spark_df.toPandas()
    od = duck(sf_dir).execute(sql).df()
    if sorted(sp.columns) != sorted(od.columns):
        return False, f"columns differ: spark={sorted(sp.columns)} oracle={sorted(od.columns)}"
    if len(sp) != len(od):
        return False, f"row count spark={len(sp)} oracle={len(od)}"
    cols = sorted(sp.columns)
    a, b = rows_of(sp, cols), rows_of(od, cols)
    if a != b:
        for i, (x, y) in enumerate(zip(a, b)):
            if x != y:
                return False, f"first diff at row {i}: cols={cols}\n spark ={x}\n oracle={y}"
    return True, f"{len(sp)} rows"
