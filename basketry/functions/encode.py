"""Binary encoding of category columns (factor code -> fixed-width bit columns).

For a column ``c`` with ``n`` distinct values (a missing value counts as one),
levels sorted ascending get codes 1..L and a missing value gets no code. The
code is written as ``k = max(1, ceil(log2(n)))`` bits, most significant first,
into ``c_bin_1 .. c_bin_k`` and ``c`` is dropped. Codes that need more than k
bits keep their low k bits (when n is a power of two the last level becomes all
zeros, as upstream); a missing value is all zeros.

Only the level table is ranked, never the data, and it joins back by broadcast
when it is provably small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.joins import BROADCAST_MAX_ROWS
from basketry.session import materialize

_CODE = "__code"
_LVL = "__level"
_PART = "__part"


def bit_width(n_levels: int) -> int:
    """``max(1, ceil(log2(n)))`` in exact integer arithmetic."""
    return max(1, (max(n_levels, 1) - 1).bit_length())


def level_codes(df: DataFrame, col: str, max_broadcast: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, int]:
    """Return (levels table ``__level, __code``, number of distinct values incl. NULL).

    The levels are range-partitioned and written, so partitions hold ascending
    ranges; a level's code is its rank inside its partition plus the levels of
    the partitions before (a running sum over one row per partition). One plan
    for any number of levels; the codes are broadcast only if their counted
    number is small.
    """
    levels = df.select(F.col(col).alias(_LVL)).distinct()
    ranged = materialize(levels.repartitionByRange(_LVL).withColumn(_PART, F.spark_partition_id()), "levels")
    n_distinct = ranged.count()  # a NULL level is one of the distinct values, as in R's unique()
    known = ranged.filter(F.col(_LVL).isNotNull())
    # one row per partition
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = known.groupBy(_PART).agg(F.count(F.lit(1)).alias("__n")).select(
        _PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(_PART).orderBy(_LVL)
    codes = known.join(F.broadcast(offsets), _PART).select(
        _LVL, (F.row_number().over(inside) + F.col("__off")).cast("long").alias(_CODE))
    return (F.broadcast(codes) if n_distinct <= max_broadcast else codes), n_distinct


def binary_encode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace each of ``cols`` by its ``<col>_bin_<i>`` bit columns (appended last)."""
    out = df
    for col in cols:
        codes, n = level_codes(out, col)
        k = bit_width(n)
        out = out.join(codes, on=out[col] == codes[_LVL], how="left")
        code = F.coalesce(F.col(_CODE), F.lit(0))
        bits = [F.shiftright(code, k - i).bitwiseAND(F.lit(1)).cast("int").alias(f"{col}_bin_{i}")
                for i in range(1, k + 1)]
        keep = [F.col(c) for c in out.columns if c not in (col, _CODE, _LVL)]
        out = out.select(*keep, *bits)
    return out
