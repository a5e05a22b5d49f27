"""Full-row ``distinct()`` that shuffles digests instead of rows.

Each row gets a 128-bit digest (two 64-bit hashes of its columns and of which of
them are NULL). The digests are grouped with a partial aggregate, so a row repeated
a million times is one partial row a task. Groups of one row need nothing more: a
row whose digest occurs once passes where it was read. Only digests that occur more
often are joined back, and of their rows the one with the smallest row number stays.

Equal digests are not taken for equal rows: a group also holds the least and the
greatest of a second, independent digest of the contents (MD5). Where these differ,
the rows of that digest are compared by their whole contents.

NULLs are equal to each other; NaN equals NaN and 0.0 equals -0.0, as in Spark's own
``distinct()``; an empty table gives an empty result. Map columns cannot be compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.joins import bounded_broadcast
from basketry.session import materialize

DIGEST = ["__d1", "__d2"]


def _comparable(df: DataFrame) -> list[Column]:
    """The columns with one form for each value: -0.0 as 0.0."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        out.append(F.when(c == 0, F.lit(0).cast(f.dataType)).otherwise(c)
                   if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c)
    return out


def row_digest(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes; which columns are NULL is part of them, since a hash of columns passes over NULLs."""
    values = _comparable(df)
    nulls = F.concat(F.lit(""), *[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])
    return F.xxhash64(nulls, *values), F.xxhash64(F.lit("second"), *reversed(values), nulls)


def _content(df: DataFrame) -> Column:
    return F.md5(F.to_json(F.struct(*[v.alias(f"c{i}") for i, v in enumerate(_comparable(df))]),
                           {"ignoreNullFields": "false"}).cast("binary"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """The distinct rows of ``df``. ``df`` must give the same rows in the same partitions when read again."""
    one, two = row_digest(df)
    marked = df.withColumns({DIGEST[0]: one, DIGEST[1]: two, "__row": F.monotonically_increasing_id()})
    groups = marked.withColumn("__check", _content(df)).groupBy(*DIGEST).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__keep"), F.min("__check").alias("__low"),
        F.max("__check").alias("__high"))
    several = materialize(groups.where(F.col("__n") > 1).select(
        *DIGEST, "__keep", (F.col("__low") != F.col("__high")).alias("__mixed")), "repeated_digests")
    joined = marked.join(bounded_broadcast(several), DIGEST, "left")
    out = joined.where(F.col("__keep").isNull() | (~F.col("__mixed") & (F.col("__row") == F.col("__keep")))).select(*df.columns)
    if several.where("__mixed").isEmpty():
        return out
    return out.unionByName(joined.where("__mixed").select(*df.columns).distinct())
