"""Running numbers inside groups that stay spread out when one group is huge.

``row_number().over(Window.partitionBy(g).orderBy(o))`` sends every row of a
group to one task. When one user (or one user/product pair) holds a third of
all rows that task holds a third of the data. The operator here cuts each group
into blocks of monotone keys, counts rows per block with a partial aggregate,
turns the counts into per-block offsets with a window over the (small) block
table, and numbers rows inside each block only. Only blocks, not groups, have to
fit into a task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.joins import BROADCAST_MAX_ROWS, bounded_count, null_safe_join

# rows of a group up to which it is one plain window; a larger one is taken in blocks
GROUP_ROWS = 1 << 14

_OFF = "__off"
_CNT = "__cnt"
_FIRST = -(1 << 63)  # block of a NULL key: NULLs sort first


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def _stand_in(dtype: T.DataType) -> Column:
    """A value of the type that stands for NULL beside a NULL flag."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    return (F.lit("") if isinstance(dtype, (T.StringType, T.BinaryType)) else F.lit(0)).cast(dtype)


def block_row_number(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column],
                     block_key: Column | Sequence[Column], block_size: int | Sequence[int], name: str) -> DataFrame:
    """Add ``name`` = 1-based row number per ``partition_by`` in ``order_by`` order.

    ``block_key`` must be numeric and never decrease along ``order_by`` inside a
    group (it is usually the first ordering column). With several keys the
    blocks are compared like tuples, so each key but the last needs block size 1
    to stay monotone. Rows are numbered exactly as ``row_number()`` would number
    them, NULL group keys being one group and NULL block keys coming first; the
    result is a LONG column.

    The offsets join back on key columns whose NULLs are replaced (with a flag
    beside them), so the join is a plain equality and its shuffle already
    clusters the rows for the in-block window (one shuffle of ``df``).
    """
    keys, sizes = ([block_key], [block_size]) if isinstance(block_key, Column) else (block_key, block_size)
    blocks = {f"__blk{i}": F.coalesce(F.floor(k / F.lit(s)).cast("long"), F.lit(_FIRST))
              for i, (k, s) in enumerate(zip(keys, sizes, strict=True))}
    groups = {}
    for i, c in enumerate(partition_by):
        groups[f"__key{i}"] = F.coalesce(F.col(c), _stand_in(df.schema[c].dataType))
        groups[f"__null{i}"] = F.col(c).isNull()
    keyed = df.withColumns({**groups, **blocks})
    counts = keyed.groupBy(*groups, *blocks).agg(F.count(F.lit(1)).alias(_CNT))
    before = Window.partitionBy(*groups).orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, *blocks, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF))
    joined = keyed.join(offsets, on=[*groups, *blocks], how="inner")
    inside = Window.partitionBy(*groups, *blocks).orderBy(*_cols(order_by))
    out = joined.withColumn(name, (F.row_number().over(inside) + F.col(_OFF)).cast("long"))
    return out.select(*df.columns, name)


def large_groups(df: DataFrame, key: str, limit: int | None = None) -> DataFrame | None:
    """Keys with more than ``limit`` (``GROUP_ROWS``) rows, broadcast if provably few; None without any.

    One partial count of the key column; ``df`` is scanned here and again by
    :func:`by_group_size`, so it should be a written table.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    large = counted.where(F.col("__rows") > (GROUP_ROWS if limit is None else limit)).select(key)
    n = bounded_count(large, BROADCAST_MAX_ROWS + 1)
    return None if not n else F.broadcast(large) if n <= BROADCAST_MAX_ROWS else large


def by_group_size(df: DataFrame, key: str, large: DataFrame | None, usual: Callable[[DataFrame], DataFrame],
                  huge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``usual`` of the rows of all groups but the ``large`` ones, ``huge`` of the others; both must give the same columns."""
    if large is None:
        return usual(df)
    marked = null_safe_join(df, large.withColumn("__large", F.lit(True)), [key])
    rest, most = marked.where("__large is null").drop("__large"), marked.where("__large").drop("__large")
    out = usual(rest)
    return out.unionByName(huge(most).select(*out.columns))
