"""The five order tables derived from the TPC-H-style test tables.

Two mappings (see FIXTURES.md):

- ``dense`` (default): a product is a (brand, type) pair, so products repeat per
  user and the reorder label is learnable. aisle = brand, department = type.
- ``part``: a product is a part; names collide across parts.

Users are customers, orders keep their keys, ``order_number`` counts a user's
orders by (date, key), the last one is ``train``, the others ``prior``.

Fixed values of the mapping: product id = (aisle_id - 1) * 6 + department_id
(six part types in the test tables); order hour = order key mod 24; order day of
week 0 = Sunday; day gaps capped at 30 and NULL for a user's first order.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions.joins import bounded_broadcast, bounded_count
from basketry.operators.ranking import block_row_number, by_group_size, large_groups
from basketry.session import materialize
from basketry.sources.tables import Tables

DEPARTMENTS_PER_AISLE = 6
HOURS = 24
GAP_CAP_DAYS = 30
MAPPINGS = ("dense", "part")

# block sizes for the skew-safe running numbers (rows of one block must fit a task)
ORDER_DATE_BLOCK_DAYS = 32
# cart position: blocks of (line number, part-key range), so one huge order splits
PART_KEY_BLOCK = 1 << 24


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dimensions(part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """aisles from brands, departments from types (sorted, 1-based)."""
    aisles = (part.select(F.col("p_brand").alias("aisle")).distinct()
              .select(F.regexp_extract("aisle", r"(\d+)", 1).cast("int").alias("aisle_id"), "aisle"))
    # part types form a closed vocabulary, so the single-partition rank is over a bounded set
    departments = (part.select(F.col("p_type").alias("department")).distinct()
                   .select(F.row_number().over(Window.orderBy("department")).cast("int")
                           .alias("department_id"), "department"))
    return aisles, departments


def _part_products(part: DataFrame, departments: DataFrame, mapping: str) -> DataFrame:
    """One row per part: p_partkey, product_id, product_name, aisle_id, department_id."""
    if mapping == "dense" and bounded_count(departments, DEPARTMENTS_PER_AISLE + 1) > DEPARTMENTS_PER_AISLE:
        raise ValueError(f"mapping dense numbers products for at most {DEPARTMENTS_PER_AISLE} part types")
    p = part.join(bounded_broadcast(departments), part.p_type == departments.department, "inner")
    aisle_id = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    if mapping == "dense":
        pid = ((aisle_id - 1) * DEPARTMENTS_PER_AISLE + F.col("department_id")).cast("long")
        name = F.concat_ws(" ", "p_brand", "p_type")
    elif mapping == "part":
        pid = F.col("p_partkey").cast("long")
        name = F.col("p_name")
    else:
        raise ValueError(f"mapping must be one of {MAPPINGS}")
    return p.select("p_partkey", pid.alias("product_id"), name.alias("product_name"),
                    aisle_id.alias("aisle_id"), F.col("department_id").cast("int").alias("department_id"))


def _with_neighbours(o: DataFrame) -> DataFrame:
    """``order_number`` per user, the date of the user's order before and whether one follows, in one window."""
    user = Window.partitionBy("user_id").orderBy("odate", "order_id")
    known = F.col("user_id").isNotNull()  # orders without a user have a number but no neighbours
    return o.select("*", F.row_number().over(user).cast("int").alias("order_number"),
                    F.when(known, F.lag("odate").over(user)).alias("prev_date"),
                    F.when(known, F.lead(F.lit(True)).over(user)).alias("has_next"))


def _with_neighbours_by_block(o: DataFrame) -> DataFrame:
    """The same for users whose orders do not fit a task."""
    day = F.datediff(F.col("odate"), F.lit("1970-01-01").cast("date"))
    o = block_row_number(o, ["user_id"], ["odate", "order_id"], day, ORDER_DATE_BLOCK_DAYS, "order_number")
    # read three times below: written once instead of numbered three times
    o = materialize(o.withColumn("order_number", F.col("order_number").cast("int")), "fx_numbered_orders")
    # previous / next order through joins on the unique key (user_id, order_number):
    # no window has to hold a whole user
    prev = o.select("user_id", (F.col("order_number") + 1).alias("order_number"),
                    F.col("odate").alias("prev_date"))
    nxt = o.select("user_id", (F.col("order_number") - 1).alias("order_number"),
                   F.lit(True).alias("has_next"))
    return o.join(prev, ["user_id", "order_number"], "left").join(nxt, ["user_id", "order_number"], "left")


def _orders(orders_src: DataFrame) -> DataFrame:
    o = orders_src.select(F.col("o_orderkey").cast("long").alias("order_id"),
                          F.col("o_custkey").cast("long").alias("user_id"),
                          F.to_date("o_orderdate").alias("odate"))
    o = by_group_size(o, "user_id", large_groups(o, "user_id"), _with_neighbours, _with_neighbours_by_block)
    gap = F.least(F.lit(GAP_CAP_DAYS), F.datediff("odate", "prev_date"))
    return o.select(
        "order_id", "user_id",
        F.when(F.col("has_next").isNull(), F.lit("train")).otherwise(F.lit("prior")).alias("eval_set"),
        "order_number",
        (F.dayofweek("odate") - 1).cast("int").alias("order_dow"),
        (F.col("order_id") % HOURS).cast("int").alias("order_hour_of_day"),
        F.when(F.col("prev_date").isNull(), F.lit(None)).otherwise(gap).cast("double")
        .alias("days_since_prior_order"))


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_discount", "l_tax"]


def _numbered_lines(lineitem: DataFrame, part_products: DataFrame) -> DataFrame:
    """order_id, product_id, add_to_cart_order for every line of a known part.

    Of a line only its product goes on, so lines that share number and part in an order are
    the same and the columns that would order them stay behind, unless a part has two products.
    """
    pp = part_products.select("p_partkey", "product_id")
    twofold = pp.groupBy("p_partkey").agg(F.min("product_id").alias("a"), F.max("product_id").alias("b"),
                                          F.count_if(F.col("product_id").isNull()).alias("c"))
    two = not twofold.where("a < b or (a is not null and c > 0)").isEmpty()
    order = LINE_ORDER if two else LINE_ORDER[:2]
    li = lineitem.select(F.col("l_orderkey").cast("long").alias("order_id"), *order)
    large = large_groups(li, "order_id")
    pp = bounded_broadcast(pp)
    li = li.join(pp, li.l_partkey == pp.p_partkey, "inner").select("order_id", *order, "product_id")

    def by_window(lines: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("order_id").orderBy(*order))
        return lines.select("order_id", "product_id", place.cast("int").alias("add_to_cart_order"))

    def by_block(lines: DataFrame) -> DataFrame:
        out = block_row_number(lines, ["order_id"], order, [F.col("l_linenumber"), F.col("l_partkey")],
                               [1, PART_KEY_BLOCK], "add_to_cart_order")
        return out.withColumn("add_to_cart_order", F.col("add_to_cart_order").cast("int"))
    return by_group_size(li, "order_id", large, by_window, by_block)


def _lines(lineitem: DataFrame, part_products: DataFrame, orders: DataFrame, write: bool = False) -> DataFrame:
    """order_id, product_id, add_to_cart_order, reordered, eval_set for every line."""
    lo = _numbered_lines(lineitem, part_products).join(
        orders.select("order_id", "user_id", "order_number", "eval_set"), "order_id", "inner")
    # a line without a user or a product has no first order to be compared with
    lo = lo.where("user_id is not null and product_id is not null")
    if write:
        # read twice below
        lo = materialize(lo, "fx_user_lines")
    # reordered: the user bought this product in an earlier order
    keys = ["user_id", "product_id"]

    def by_window(lines: DataFrame) -> DataFrame:
        return lines.withColumn("first_order_number", F.min("order_number").over(Window.partitionBy(*keys)))

    def by_join(lines: DataFrame) -> DataFrame:
        # min is a partial aggregate
        return lines.join(lines.groupBy(*keys).agg(F.min("order_number").alias("first_order_number")), keys, "inner")
    lo = by_group_size(lo, "user_id", large_groups(lo, "user_id"), by_window, by_join)
    return lo.select("order_id", "product_id", "add_to_cart_order",
                     (F.col("order_number") > F.col("first_order_number")).cast("int").alias("reordered"),
                     "eval_set")


def tpch_tables(spark: SparkSession, sf_dir: str, mapping: str = "dense", persist: bool = False,
                materialize_tables: bool = False) -> Tables:
    """Build :class:`Tables` from ``orders``, ``lineitem`` and ``part`` under ``sf_dir``.

    ``persist=True`` keeps the derived tables (memory, spilling to disk) so that
    many queries in one session derive them once; lost blocks are recomputed
    from the lineage. ``materialize_tables=True`` instead writes them once as
    Parquet to the shared checkpoint folder: later plans start from plain
    scans (with pushed filters and pruned columns) and the lineage is cut.
    """
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    aisles, departments = _dimensions(part)
    pp = _part_products(part, departments, mapping)
    products = pp.select("product_id", "product_name", "aisle_id", "department_id").distinct()
    orders = _orders(_read(spark, sf_dir, "orders"))
    if materialize_tables:
        # written before the lines are derived, so the lines' join reads it instead of re-deriving it
        orders = materialize(orders, "fx_orders")
    lines = _lines(_read(spark, sf_dir, "lineitem"), pp, orders, materialize_tables)
    if materialize_tables:
        lines = materialize(lines, "fx_lines")
        products, aisles, departments = (materialize(products, "fx_products"), materialize(aisles, "fx_aisles"),
                                         materialize(departments, "fx_departments"))
    elif persist:
        level = StorageLevel.MEMORY_AND_DISK
        orders, lines = orders.persist(level), lines.persist(level)
        products, aisles, departments = (products.persist(level), aisles.persist(level),
                                         departments.persist(level))
    cols = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    return Tables(
        orders=orders,
        products=products,
        aisles=aisles,
        departments=departments,
        order_products_prior=lines.filter(F.col("eval_set") == "prior").select(*cols),
        order_products_train=lines.filter(F.col("eval_set") == "train").select(*cols),
    )
