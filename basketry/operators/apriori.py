"""Level-wise itemset mining on vertical bitmaps.

Baskets are numbered inside their partition and cut into ranges of ``RANGE``
baskets; an item's bitmap over a range is an array of 64-bit words. Level k + 1
starts from the frequent sets of level k: two sets that share all but their last
item make a candidate (prefix join), and a candidate lives only if all its other
subsets of size k are frequent too. A candidate's bitmap over a range is the AND of
the bitmaps of the two sets it was made of, found by (range, set), and its count the
sum of ``bit_count`` over the words. Bitmaps of frequent sets are written and feed
the next level; the levels end when no set is frequent. There is no limit on the
size of a set.

What is shuffled are bitmaps of at most 512 bytes per (range, frequent set); no task
ever lists the pairs of a basket or of a range. A set's count is a partial sum, and a
range is one of many rows of a set, so neither a frequent item nor a long basket
makes a hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.joins import bounded_broadcast
from basketry.operators.rules import basket_count, min_count
from basketry.session import materialize

WORDS = 64
RANGE = 64 * WORDS     # baskets of a range


def item_bitmaps(baskets: DataFrame) -> DataFrame:
    """``set`` (one item), ``range``, ``words``: which baskets of the range hold the item."""
    # numbers are dense inside a partition, so its ranges are full but for the last one
    numbered = baskets.select(F.monotonically_increasing_id().alias("b"), "items")
    lines = numbered.select("b", F.explode(F.array_distinct("items")).alias("item")).where("item is not null")
    bit = F.expr("shiftleft(1L, cast(b & 63 as int))")
    words = lines.groupBy("item", F.shiftright("b", 12).alias("range"), F.expr(f"cast(shiftright(b, 6) & {WORDS - 1} as int)").alias("w")) \
        .agg(F.bit_or(bit).alias("bits"))
    # at most WORDS entries a range
    return words.groupBy("item", "range").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m")).select(
        F.array("item").alias("set"), "range",
        F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.col("m")[w], F.lit(0))).alias("words"))


def _bits(words: Column) -> Column:
    return F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w))


def _counts(bitmaps: DataFrame, need: int) -> DataFrame:
    return bitmaps.groupBy("set").agg(F.sum(_bits(F.col("words"))).alias("n")).where(F.col("n") >= need)


def candidates(frequent: DataFrame, k: int) -> DataFrame:
    """``left``, ``right`` (frequent sets of size k) and ``set``, their union, all of whose subsets of size k are frequent."""
    named = frequent.select("set", F.slice("set", 1, k - 1).alias("prefix"), F.col("set")[k - 1].alias("last"))
    right = named.select("prefix", F.col("set").alias("right"), F.col("last").alias("other"))
    made = named.join(right, "prefix").where("last < other").select(
        F.col("set").alias("left"), "right", F.concat("set", F.array("other")).alias("set"))
    if k == 1:
        return made
    # the two parents are frequent; the subsets that lack one of the first k - 1 items are looked up
    subsets = made.select("left", "right", "set", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(k - 1)), lambda i: F.concat(
            F.slice("set", F.lit(1), i - 1), F.slice("set", i + 1, F.lit(k + 1) - i)))).alias("part"))
    known = frequent.select(F.col("set").alias("part"))
    return subsets.join(known, "part").groupBy("left", "right", "set").agg(F.count(F.lit(1)).alias("found")) \
        .where(F.col("found") == k - 1).select("left", "right", "set")


def _joined(bitmaps: DataFrame, made: DataFrame) -> DataFrame:
    """``set``, ``range``, ``words`` of the sets in ``made``; ranges without a common basket are left out."""
    made = bounded_broadcast(made)
    left = bitmaps.select(F.col("set").alias("left"), "range", F.col("words").alias("a")).join(made, "left")
    right = bitmaps.select(F.col("set").alias("right"), "range", F.col("words").alias("b"))
    both = left.join(right, ["range", "right"]).select("set", "range", F.zip_with("a", "b", lambda a, b: a.bitwiseAND(b)).alias("words"))
    return both.where(F.exists("words", lambda w: w != 0))


def frequent_sets(baskets: DataFrame, min_support: float) -> DataFrame:
    """``set`` (sorted items) and ``n`` of every itemset in at least ``ceil(min_support * baskets)`` baskets."""
    need = max(1, min_count(min_support, basket_count(baskets)))
    # written, so that every level reads one numbering of the baskets
    bitmaps = materialize(item_bitmaps(baskets), "apriori_bitmaps")
    found = materialize(_counts(bitmaps, need), "apriori_sets")
    bitmaps = materialize(bitmaps.join(bounded_broadcast(found.select("set")), "set", "left_semi"), "apriori_bitmaps")
    levels, k = [found], 1
    while not found.isEmpty():
        made = materialize(candidates(found, k), "apriori_candidates")
        counted = materialize(_counts(_joined(bitmaps, made), need), "apriori_sets")
        if not counted.isEmpty():
            bitmaps = materialize(_joined(bitmaps, made.join(bounded_broadcast(counted.select("set")), "set", "left_semi")),
                                  "apriori_bitmaps")
            levels.append(counted)
        found, k = counted, k + 1
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def itemsets(baskets: DataFrame, min_support: float) -> DataFrame:
    """``items`` (sorted), ``freq``, ``support``; the result of :func:`~basketry.operators.rules.frequent_itemsets`."""
    n = float(max(basket_count(baskets), 1))
    return frequent_sets(baskets, min_support).select(F.col("set").alias("items"), F.col("n").alias("freq"),
                                                      (F.col("n") / F.lit(n)).alias("support"))


def rules_of(sets: DataFrame, n_baskets: int, min_confidence: float, min_items: int = 2) -> DataFrame:
    """B4 + B5: rules with one item on the right from frequent sets (``set``, ``n``) of all sizes."""
    big_n = F.lit(float(max(n_baskets, 1)))
    parts = sets.where(F.size("set") >= max(2, min_items)).select("set", "n", F.explode("set").alias("y")).select(
        "n", "y", F.array_except("set", F.array("y")).alias("x"))
    left = sets.select(F.col("set").alias("x"), F.col("n").alias("nx"))
    right = sets.where(F.size("set") == 1).select(F.col("set")[0].alias("y"), F.col("n").alias("ny"))
    rules = parts.join(left, "x").join(bounded_broadcast(right), "y")
    n, nx, ny = (F.col(c).cast("double") for c in ("n", "nx", "ny"))
    return rules.select(F.col("x").alias("antecedent"), F.array("y").alias("consequent"), (n / big_n).alias("support"),
                        (n / nx).alias("confidence"), (n / nx / (ny / big_n)).alias("lift"), (nx / big_n).alias("coverage"),
                        F.col("n").alias("count")).where(F.col("confidence") >= F.lit(min_confidence))


def apriori_rules(baskets: DataFrame, min_support: float, min_confidence: float, min_items: int = 2) -> DataFrame:
    """Rules of all sizes, level-wise."""
    return rules_of(frequent_sets(baskets, min_support), basket_count(baskets), min_confidence, min_items)
