"""Join helpers: size-checked broadcast and NULL-matching equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when a bounded count proves it has at most this
# many rows; otherwise the join stays a shuffle join (and AQE may still convert
# it at run time from real shuffle sizes).
BROADCAST_MAX_ROWS = 200_000


def bounded_count(df: DataFrame, limit: int) -> int:
    """``min(rows of df, limit)``, reading as little as possible.

    ``limit(k).collect()`` of a one-literal projection is planned as an
    incremental take: it scans one partition, then four times as many, and so
    on, and stops as soon as ``k`` rows are seen. A large table is therefore
    rejected after its first partition; a small one is read once, without its
    columns. At most ``limit`` one-field rows reach the driver.
    """
    return len(df.select(F.lit(1).alias("one")).limit(limit).collect())


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Return ``broadcast(df)`` if ``df`` provably has <= ``max_rows`` rows."""
    return F.broadcast(df) if bounded_count(df, max_rows + 1) <= max_rows else df


def broadcast_bounded_by(df: DataFrame, domain: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` when its key domain ``domain`` provably has < ``max_rows`` rows.

    For an aggregate keyed by a dimension key (per aisle, per product, ...) the
    row count is at most the dimension size plus one NULL group, so the cheap
    bounded count runs on the dimension and never re-computes the aggregate.
    """
    return F.broadcast(df) if bounded_count(domain, max_rows) < max_rows else df


def limited_broadcast(df: DataFrame, n: int) -> DataFrame:
    """Broadcast the first ``n`` rows of an ordered frame: the limit is the bound."""
    return F.broadcast(df.limit(n))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL, keeping one copy of each key.

    R's dplyr joins match missing keys to each other; SQL ``=`` does not.
    """
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys]
    out = left.join(renamed, on=cond, how=how)
    if how in ("left", "left_outer", "inner", "left_semi", "left_anti"):
        return out.drop(*[f"__r_{k}" for k in keys])
    for k in keys:
        out = out.withColumn(k, F.coalesce(F.col(k), F.col(f"__r_{k}"))).drop(f"__r_{k}")
    return out
