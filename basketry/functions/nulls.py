"""R-style missing-value rules expressed as Spark columns.

- ``sum(x, na.rm=TRUE)`` of no values is 0, Spark's ``sum`` is NULL -> ``r_sum``.
- ``sd`` of one value is NA and the analysis then sets it to 0 -> ``fill_zero``.
- ``mean`` of no values is NaN in R; Spark gives NULL, which is kept (documented).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def r_sum(c: str | Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def fill_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Replace NULL (and NaN, which R's ``is.na`` also matches) by 0 in ``cols``."""
    cols = list(cols)
    types = dict(df.dtypes)
    out = df
    for c in cols:
        expr = F.col(c)
        if types[c] in ("double", "float"):
            expr = F.when(F.isnan(expr), F.lit(0.0)).otherwise(expr)
        out = out.withColumn(c, F.coalesce(expr, F.lit(0).cast(types[c])))
    return out


def is_na(c: str | Column, dtype: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if dtype in ("double", "float"):
        return col.isNull() | F.isnan(col)
    return col.isNull()
