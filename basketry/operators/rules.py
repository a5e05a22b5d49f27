"""Association rules over baskets: support, confidence, lift, coverage, count.

Definitions for a rule X -> y over N baskets: count = baskets holding X and y;
support = count / N; coverage = baskets holding X / N; confidence =
count / baskets holding X; lift = confidence / (baskets holding y / N).
A rule is kept when support >= min_support (count >= ceil(min_support * N))
and confidence >= min_confidence. Right-hand sides have one item.

Miners (:mod:`~basketry.operators.apriori` is a third one, level-wise):

- :func:`pair_rules` - rules with one item on each side, exact and fully
  distributed. A basket is cut to its frequent items and lists each of its pairs
  once (smaller item first), and the pairs are counted with partial aggregation, so
  a task ships at most one row per pair of frequent items.
- :func:`fpgrowth_rules` - all itemset sizes with Spark ML's FP-growth
  (``pyspark.ml.fpm.FPGrowth``), all itemset sizes unless ``max_items`` is given.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.joins import bounded_broadcast

RULE_COLS = ["antecedent", "consequent", "support", "confidence", "lift", "coverage", "count"]

def basket_count(baskets: DataFrame) -> int:
    return baskets.count()


def min_count(min_support: float, n_baskets: int) -> int:
    return int(math.ceil(min_support * n_baskets))


def item_counts(baskets: DataFrame) -> DataFrame:
    """Baskets holding each item (items of a basket are distinct)."""
    return baskets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


NAMES_IN_PLAN = 1 << 12   # frequent items that are written into the plan; more of them are joined


def _frequent_only(baskets: DataFrame, frequent: DataFrame) -> DataFrame:
    """Baskets as sorted arrays of their frequent items; without a shuffle while the frequent items are few."""
    names = [r[0] for r in frequent.select("item").limit(NAMES_IN_PLAN + 1).collect()]
    if len(names) <= NAMES_IN_PLAN:
        held = F.array(*[F.lit(x) for x in sorted(names)]) if names else F.array().cast("array<string>")
        return baskets.select(F.sort_array(F.array_intersect("items", held)).alias("items"))
    # a basket's row number only has to tell baskets apart, whatever columns the caller's table has
    numbered = baskets.select(F.monotonically_increasing_id().alias("basket"), "items")
    return numbered.select("basket", F.explode("items").alias("item")).join(frequent.select("item"), "item", "left_semi").groupBy("basket").agg(
        F.sort_array(F.collect_set("item")).alias("items"))


def pair_counts(baskets: DataFrame, frequent: DataFrame) -> DataFrame:
    """(x, nx, y, ny, count) of every pair of frequent items that share a basket, x < y.

    ``frequent`` is (item, n). The baskets' items are cut to the frequent ones inside
    their array, each basket lists its pairs once, and the counting aggregate is
    partial.
    """
    kept = _frequent_only(baskets, frequent)
    pairs = F.flatten(F.transform("items", lambda a, i: F.transform(
        F.slice("items", i + 2, F.size("items")), lambda b: F.struct(a.alias("x"), b.alias("y")))))
    counts = kept.where(F.size("items") > 1).select(F.explode(pairs).alias("p")).groupBy(
        F.col("p.x").alias("x"), F.col("p.y").alias("y")).agg(F.count(F.lit(1)).alias("count"))
    left = bounded_broadcast(frequent.select(F.col("item").alias("x"), F.col("n").alias("nx")))
    right = bounded_broadcast(frequent.select(F.col("item").alias("y"), F.col("n").alias("ny")))
    return counts.join(left, "x").join(right, "y").select("x", "nx", "y", "ny", "count")


def pair_rules(baskets: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """Rules {x} -> {y}; array columns ``antecedent``/``consequent`` as FP-growth gives them.

    Runs small actions (basket count, a bounded count of the frequent items)
    before the lazy result; callers should keep ``baskets`` if it is expensive.
    """
    n = basket_count(baskets)
    need = min_count(min_support, n)
    frequent = item_counts(baskets).filter(F.col("n") >= need)
    pc = pair_counts(baskets, frequent).filter(F.col("count") >= need)
    both = pc.unionByName(pc.select(F.col("y").alias("x"), F.col("ny").alias("nx"), F.col("x").alias("y"),
                                    F.col("nx").alias("ny"), "count"))
    big_n = F.lit(n).cast("double")
    r = both.select(
        F.array("x").alias("antecedent"), F.array("y").alias("consequent"),
        (F.col("count") / big_n).alias("support"),
        (F.col("count") / F.col("nx").cast("double")).alias("confidence"),
        # count*N / (nx*ny) as double products (64-bit integers overflow at ~1e10 baskets); the
        # products commute, so lift(x->y) == lift(y->x) bit for bit
        ((F.col("count").cast("double") * big_n) / (F.col("nx").cast("double") * F.col("ny").cast("double")))
        .alias("lift"),
        (F.col("nx") / big_n).alias("coverage"),
        F.col("count"),
    )
    return r.filter(F.col("confidence") >= F.lit(min_confidence))


def fpgrowth_model(baskets: DataFrame, min_support: float, min_confidence: float, num_partitions: int | None = None):
    fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    return fp.fit(baskets.select("items"))


def _at_most(size, max_items: int | None):
    return F.lit(True) if max_items is None else size <= max_items


def frequent_itemsets(baskets: DataFrame, min_support: float, max_items: int | None = None) -> DataFrame:
    """``items`` (sorted), ``freq``, ``support`` of itemsets with support >= min_support.

    ``max_items`` is an optional cut of the miner's result; None keeps all sizes.
    """
    n = basket_count(baskets)
    model = fpgrowth_model(baskets, min_support, 1.0, int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return model.freqItemsets.filter(_at_most(F.size("items"), max_items)).select(
        F.sort_array("items").alias("items"), F.col("freq").cast("long").alias("freq"),
        (F.col("freq") / F.lit(float(max(n, 1)))).alias("support"))


def fpgrowth_rules(baskets: DataFrame, min_support: float, min_confidence: float,
                   max_items: int | None = None, min_items: int = 2) -> DataFrame:
    """B4 + B5: rules of any antecedent size from FP-growth, with coverage and count.

    The conditional trees are spread over the session's shuffle partitions.
    ``max_items`` optionally cuts the result by itemset size; None keeps all.
    """
    n = basket_count(baskets)
    width = int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    model = fpgrowth_model(baskets, min_support, min_confidence, width)
    r = model.associationRules
    size = F.size("antecedent") + 1
    r = r.filter(_at_most(size, max_items) & (size >= min_items))
    return r.select(
        F.sort_array("antecedent").alias("antecedent"), "consequent", "support", "confidence", "lift",
        (F.col("support") / F.col("confidence")).alias("coverage"),
        F.round(F.col("support") * F.lit(n)).cast("long").alias("count"))


def filter_lift(rules: DataFrame, min_lift: float = 1.0) -> DataFrame:
    """Rules with lift strictly above ``min_lift``."""
    return rules.filter(F.col("lift") > F.lit(min_lift))


def sort_rules(rules: DataFrame) -> DataFrame:
    """By lift descending; ties by support descending, then the item lists."""
    return rules.orderBy(F.desc("lift"), F.desc("support"), F.array_join("antecedent", "\u0001"),
                         F.array_join("consequent", "\u0001"))


def top_rules(rules: DataFrame, n: int, min_lift: float = 1.0) -> DataFrame:
    """Lift filter, sort, first ``n`` (one TakeOrderedAndProject)."""
    return sort_rules(filter_lift(rules, min_lift)).limit(n)


def rule_labels(rules: DataFrame) -> DataFrame:
    """Rules with item lists as text ``{a,b}`` (the way rules are printed upstream)."""
    lab = lambda c: F.concat(F.lit("{"), F.array_join(c, ","), F.lit("}"))
    rest = [c for c in rules.columns if c not in ("antecedent", "consequent")]
    return rules.select(lab("antecedent").alias("lhs"), lab("consequent").alias("rhs"), *rest)
