"""Product frequency, top-N products, frequent lines, baskets and incidence.

Support in the rule miner is relative to the baskets that hold at least one
top-N product, not to all orders: the lines are cut to the top-N products
before baskets are formed, exactly as upstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.joins import bounded_broadcast, limited_broadcast

PRODUCT_COLS = ["product_id", "product_name", "aisle_id", "department_id"]


def product_frequency(lines: DataFrame) -> DataFrame:
    """G1: number of order lines per product."""
    return lines.groupBy("product_id").agg(F.count(F.lit(1)).alias("frequency"))


def top_product_frequency(lines: DataFrame, n: int) -> DataFrame:
    """``product_id, frequency`` of the ``n`` most frequent products (ties: smaller id)."""
    return product_frequency(lines).orderBy(F.desc("frequency"), F.asc("product_id")).limit(n)


def top_products(lines: DataFrame, products: DataFrame, n: int) -> DataFrame:
    """T1 + J5: the ``n`` most frequent products (ties: smaller id first) with attributes.

    The sort + limit is planned as one TakeOrderedAndProject (per-partition
    top-n, then a merge of n rows per partition), never a global sort.
    """
    top = top_product_frequency(lines, n)
    # products of the top n: the product table is streamed once against the n broadcast ids
    # (no shuffle of the catalog, whatever its size); at most n rows match if product_id is
    # its key, which the count of the matching rows checks before they are broadcast
    attrs = products.select(*PRODUCT_COLS).join(F.broadcast(top.select("product_id")), "product_id", "left_semi")
    return top.join(bounded_broadcast(attrs), "product_id", "left") \
        .select("product_id", "frequency", "product_name", "aisle_id", "department_id")


def frequent_order_lines(lines: DataFrame, n: int) -> DataFrame:
    """P3 + P7: the lines whose product is one of the top ``n`` (broadcast semi join)."""
    keys = top_product_frequency(lines, n).select("product_id")
    return lines.join(limited_broadcast(keys, n), "product_id", "left_semi") \
        .select(*lines.columns)


def lines_with_products(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with product attributes (left join)."""
    return lines.join(bounded_broadcast(products.select(*PRODUCT_COLS)), "product_id", "left") \
        .select(*lines.columns, "product_name", "aisle_id", "department_id")


def baskets(named_lines: DataFrame, item_col: str = "product_name") -> DataFrame:
    """B2: one row per order with its distinct items, sorted.

    Products sharing a name merge into one item (the upstream incidence table
    has one column per name). Because only top-N items reach this step a
    basket holds at most N items, so the per-order set is bounded even when
    one order is huge; ``collect_set`` is aggregated partially on the map
    side, so each task ships at most N names per order in one shuffle.
    """
    named = named_lines.filter(F.col(item_col).isNotNull())
    return named.groupBy("order_id").agg(F.sort_array(F.collect_set(item_col)).alias("items"))


def basket_incidence(named_lines: DataFrame, item_values: list[str], item_col: str = "product_name") -> DataFrame:
    """B1 + G11 + P5: order x item table of booleans (True if the order holds the item).

    ``item_values`` fixes the columns (and saves the job that would discover
    them); a missing cell is False, as in the upstream table.
    """
    wide = named_lines.groupBy("order_id").pivot(item_col, item_values) \
        .agg(F.count("product_id") >= 1)
    return wide.select("order_id", *[F.coalesce(F.col(f"`{v}`"), F.lit(False)).alias(v) for v in item_values])


def numbered_incidence(named_lines: DataFrame, names: list[str], n: int, item_col: str = "product_name") -> DataFrame:
    """The incidence table under fixed column names: ``item_001`` .. for the sorted names, False beyond the last one."""
    wide = basket_incidence(named_lines, names, item_col)
    cells = [F.col(f"`{names[i]}`") if i < len(names) else F.lit(False) for i in range(n)]
    return wide.select("order_id", *[c.alias(f"item_{i + 1:03d}") for i, c in enumerate(cells)])


def item_names(top: DataFrame) -> list[str]:
    """Distinct item names of a top-N frame (at most N values, so collecting is bounded)."""
    return sorted({r[0] for r in top.select("product_name").distinct().collect() if r[0] is not None})
