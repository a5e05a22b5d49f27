"""Table profiling: shape, missing values per column, schema listing, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.nulls import is_na


def shape(df: DataFrame, name: str) -> DataFrame:
    """Q1: ``table, n_rows, n_cols`` (one counting aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"))


def shapes(named: dict[str, DataFrame]) -> DataFrame:
    frames = [shape(df, name) for name, df in named.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def null_counts(df: DataFrame) -> DataFrame:
    """Q2: ``column, na_count`` for every column in one pass (NaN counts as missing)."""
    types = dict(df.dtypes)
    aggs = [F.count_if(is_na(c, types[c])).alias(f"c{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(df.columns))
    return wide.selectExpr(f"stack({len(df.columns)}, {pairs}) as (`column`, na_count)")


def schema_table(df: DataFrame) -> DataFrame:
    """Q3: ``position, column, type, n_values`` of a frame; one pass counts the values present."""
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = ", ".join(f"{i + 1}, '{name}', '{dtype}', c{i}" for i, (name, dtype) in enumerate(df.dtypes))
    return wide.selectExpr(f"stack({len(df.columns)}, {rows}) as (position, `column`, type, n_values)")


def preview(df: DataFrame, order_by: list[str], n: int = 6) -> DataFrame:
    """Q4: the first ``n`` rows in key order (a top-n, not a sort)."""
    return df.orderBy(*order_by).limit(n)
