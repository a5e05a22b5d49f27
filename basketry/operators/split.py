"""Deterministic train / hold-out split on a hash bucket of the row key.

Rows have no index in Spark, so the split is a pure function of the row's own
columns and survives recomputation after an executor loss. The bucket uses
only columns kept in the final feature table.

Fixed values: bucket = (user_id * 7919 + order_number * 104729 + product_id * 31
+ add_to_cart_order * 17) mod 100 in 64-bit arithmetic; train when bucket < 80.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.config import LABEL_COL, TRAIN_FRACTION_PERCENT
from basketry.functions.joins import bounded_broadcast, null_safe_join
from basketry.operators.ranking import block_row_number
from basketry.session import materialize

BUCKETS = 100


def split_bucket() -> Column:
    key = (F.col("user_id").cast("long") * 7919 + F.col("order_number").cast("long") * 104729
           + F.col("product_id").cast("long") * 31 + F.col("add_to_cart_order").cast("long") * 17)
    return F.pmod(key, F.lit(BUCKETS))


def split_train(df: DataFrame, percent: int = TRAIN_FRACTION_PERCENT) -> DataFrame:
    """M1: the training rows."""
    return df.filter(split_bucket() < percent)


def split_holdout(df: DataFrame, percent: int = TRAIN_FRACTION_PERCENT) -> DataFrame:
    """The complement of :func:`split_train`."""
    return df.filter(split_bucket() >= percent)


def split_balance(df: DataFrame, percent: int = TRAIN_FRACTION_PERCENT, label: str = LABEL_COL) -> DataFrame:
    """Rows and label share per side of the split: ``part, n_rows, label_share``."""
    part = F.when(split_bucket() < percent, F.lit("train")).otherwise(F.lit("holdout"))
    return df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n_rows"),
                                              F.avg(label).alias("label_share"))


# hash order inside a class: 2**64 hash values cut into blocks of 2**44 (at most 2**20 blocks)
_HASH_BLOCK = 1 << 44


def split_stratified(df: DataFrame, percent: int = TRAIN_FRACTION_PERCENT, label: str = LABEL_COL,
                     train: bool = True) -> DataFrame:
    """Exact per-class split: in every label class, the first ceil(n_class * percent / 100)
    rows by a hash of the row key are training rows, the rest hold-out rows.

    A class is a huge group (one class may hold most rows), so the rank inside
    it is computed with the block-wise running number rather than a window
    over the class; the class sizes come from one aggregate (one row per class).
    """
    h = F.xxhash64("user_id", "order_number", "product_id", "add_to_cart_order")
    keyed = df.withColumn("__h", h)
    ranked = block_row_number(keyed, [label], ["__h", "user_id", "order_number", "product_id", "add_to_cart_order"],
                              F.col("__h"), _HASH_BLOCK, "__rank")
    sizes = df.groupBy(label).agg(F.ceil(F.count(F.lit(1)) * F.lit(percent) / F.lit(100)).alias("__k"))
    cut = null_safe_join(ranked, bounded_broadcast(sizes), [label], "inner")  # one row per class, NULL being one
    side = F.col("__rank") <= F.col("__k")
    return cut.filter(side if train else ~side).select(*df.columns)


# ---------------------------------------------------------------- exact shares without ranking the rows
HALF = 16   # bits of the hash that one histogram looks at
KEYS = ["user_id", "order_number", "product_id", "add_to_cart_order"]


def split_hash() -> Column:
    """A 32-bit hash of the row key in plain arithmetic: the key's number, cut to 31 bits, times 1103515245 plus 12345."""
    key = (F.col("user_id").cast("long") * 7919 + F.col("order_number").cast("long") * 104729
           + F.col("product_id").cast("long") * 31 + F.col("add_to_cart_order").cast("long") * 17)
    return F.pmod(F.pmod(key, F.lit(2147483647)) * 1103515245 + 12345, F.lit(4294967296))


def numeric_strata(df: DataFrame, label: str, groups: int = 5) -> Column:
    """Strata of a numeric label: between its distinct quantiles, ``groups`` of them with both ends; NULL is its own."""
    shares = [i / (groups - 1) for i in range(groups)]
    breaks = sorted(set(df.agg(F.percentile_approx(label, shares, 10000)).first()[0] or []))
    stratum = F.lit(0)
    for b in breaks[1:-1]:
        stratum = stratum + F.when(F.col(label) > F.lit(b), 1).otherwise(0)
    return F.when(F.col(label).isNotNull(), stratum)


def _boundary(hist: DataFrame, value: str, out: str) -> DataFrame:
    """Per stratum the first histogram value at which ``__need`` rows are reached, and what is still needed from it.

    The window runs over a histogram of at most 2**16 rows a stratum, not over the data.
    """
    order = Window.partitionBy("__s").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = hist.withColumn("__upto", F.sum("__n").over(order))
    at = upto.where((F.col("__upto") >= F.col("__need")) & (F.col("__upto") - F.col("__n") < F.col("__need")))
    return at.select("__s", F.col(value).alias(out), (F.col("__need") - F.col("__upto") + F.col("__n")).alias("__need"),
                     F.col("__n").alias("__here"))


def exact_sides(df: DataFrame, stratum: Column, percent: int = TRAIN_FRACTION_PERCENT, out: str = "part") -> DataFrame:
    """M1: ``df`` with ``part`` ("train" / "holdout"); in every stratum exactly ceil(n * percent / 100) rows are "train".

    These are the rows with the smallest hashes of their key. Their limit is found by
    two histograms, of the upper and then, inside the bucket that holds the limit, of
    the lower half of the hash; each is one partial aggregate, and no row is ranked
    or shuffled. Only rows whose whole hash equals the limit are ordered (by their
    key), and only if not all of them are needed. NULL is a stratum of its own.
    """
    # a stratum's text stands for it in the joins, with a mark in front, so NULL matches NULL
    named = F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit("NULL"))
    keyed = df.withColumns({"__s": named, "__h": split_hash()})
    high, low = F.shiftright("__h", HALF), F.col("__h").bitwiseAND(F.lit((1 << HALF) - 1))
    first = keyed.groupBy("__s", high.alias("__high")).agg(F.count(F.lit(1)).alias("__n"))
    total = F.sum("__n").over(Window.partitionBy("__s"))
    need = F.ceil(total * F.lit(percent) / F.lit(100)).cast("long")
    bucket = materialize(_boundary(first.withColumn("__need", need), "__high", "__top"), "split_buckets")
    inside = keyed.withColumn("__high", high).join(bounded_broadcast(bucket.select("__s", F.col("__top").alias("__high"), "__need")),
                                                   ["__s", "__high"])
    second = inside.groupBy("__s", low.alias("__low"), "__need").agg(F.count(F.lit(1)).alias("__n"))
    limits = _boundary(second, "__low", "__bottom").join(bucket.select("__s", "__top"), "__s").select(
        "__s", (F.shiftleft("__top", HALF) + F.col("__bottom")).alias("__limit"), "__need", "__here")
    limits = materialize(limits, "split_limits")
    sided = keyed.join(bounded_broadcast(limits), "__s")
    split_limit = (F.col("__h") == F.col("__limit")) & (F.col("__need") < F.col("__here"))
    side = F.when(F.col("__h") <= F.col("__limit"), "train").otherwise("holdout")
    clear = sided.where(~split_limit).select(*df.columns, side.alias(out))
    if limits.where("__need < __here").isEmpty():
        return clear
    order = F.row_number().over(Window.partitionBy("__s").orderBy(*KEYS))
    tied = sided.where(split_limit).withColumn("__rank", order)
    return clear.unionByName(tied.select(*df.columns, F.when(F.col("__rank") <= F.col("__need"), "train")
                                         .otherwise("holdout").alias(out)))
