"""Per-product, per-aisle, per-department and per-user reorder features.

All measures are plain aggregates (partial + final hash aggregation, so a hot
key is pre-combined on the map side); the line-grain table is joined to the
per-key results afterwards. Output names keep the upstream spelling, including
``reorder_propotion_by_user``.

Counting rules carried over: ``total_orders`` and friends count *lines*
(``n()``), not distinct orders; ``user_buy_product_times`` is the running
occurrence number of a product in a user's history, not a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.encode import binary_encode
from basketry.functions.joins import bounded_broadcast, broadcast_bounded_by, null_safe_join
from basketry.functions.nulls import fill_zero, r_sum
from basketry.operators.ranking import block_row_number, by_group_size, large_groups
from basketry.session import materialize
from basketry.sources.tables import Tables

# Column names of the input tables and of the feature measures, as upstream
# (including the spelling "reorder_propotion_by_user").
ORDER_COLS = ["order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day",
              "days_since_prior_order"]
LINE_COLS = ["product_id", "add_to_cart_order", "reordered"]
PRODUCT_ATTR_COLS = ["product_name", "aisle_id", "department_id"]

PRODUCT_MEASURES = ["mean_add_to_cart_order", "total_orders", "total_reorders", "reorder_percentage",
                    "unique_users", "order_first_time_total_cnt", "order_second_time_total_cnt"]
GROUP_MEASURES = ["mean_add_to_cart_order", "total_orders", "total_reorders", "reorder_percentage",
                  "unique_users"]
USER_MEASURES = ["avg_dow", "std_dow", "avg_doh", "std_doh", "avg_since_order", "std_since_order",
                 "total_orders_by_user", "total_products_by_user", "total_unique_product_by_user",
                 "total_reorders_by_user", "reorder_propotion_by_user"]
STD_COLS = ["std_dow", "std_doh", "std_since_order"]
ENCODED_COLS = ["aisle", "department"]
OCCURRENCE = "user_buy_product_times"

# lines of a user up to which the occurrence number is one plain window; a user above is numbered in blocks
USER_LINES = 1 << 14

# cart positions in a block of the skew-safe occurrence number (blocks never span orders)
OCCURRENCE_BLOCK_LINES = 4096


def fill_days_since_prior(orders: DataFrame) -> DataFrame:
    """A user's first order has no gap; it becomes 0."""
    return fill_zero(orders, ["days_since_prior_order"])


def join_orders_lines(tables: Tables, scope: str = "train") -> DataFrame:
    """Orders (gap filled) inner-joined to the order lines of ``scope``."""
    orders = fill_days_since_prior(tables.orders).select(*ORDER_COLS)
    return orders.join(tables.lines(scope).select("order_id", *LINE_COLS), "order_id", "inner") \
        .select(*ORDER_COLS, *LINE_COLS)


def with_product_attributes(lines: DataFrame, tables: Tables) -> DataFrame:
    """Name, aisle and department of each line's product; NULL for an unknown product."""
    products = bounded_broadcast(tables.products.select("product_id", *PRODUCT_ATTR_COLS))
    return lines.join(products, "product_id", "left")


def order_line_base(tables: Tables, scope: str = "train") -> DataFrame:
    """J1 + J2: order lines with order attributes and product attributes."""
    base = with_product_attributes(join_orders_lines(tables, scope), tables)
    return base.select(*ORDER_COLS, *LINE_COLS, *PRODUCT_ATTR_COLS)


def user_unique_products(base: DataFrame) -> DataFrame:
    """Distinct products per user (first purchases, where the occurrence number tells them)."""
    distinct = (F.count_if(F.col(OCCURRENCE) == 1) if OCCURRENCE in base.columns
                else F.count_distinct("product_id"))
    return base.groupBy("user_id").agg(distinct.alias("unique_product_count"))


def with_user_unique_products(base: DataFrame) -> DataFrame:
    """G2 + J6: the per-user distinct product count joined back to every line."""
    rest = [c for c in base.columns if c != OCCURRENCE]
    last = [OCCURRENCE] if OCCURRENCE in base.columns else []
    return base.join(user_unique_products(base), "user_id", "left").select(*rest, "unique_product_count", *last)


def with_occurrence_number(base: DataFrame) -> DataFrame:
    """``user_buy_product_times`` = 1, 2, ... over a user's lines of one product.

    Ordered by (order_number, add_to_cart_order, order_id). ``base`` is scanned
    twice, so it should be a written table. A count per user (one pre-aggregated
    column) finds users with more than ``USER_LINES`` lines; their lines are
    numbered in blocks of (order number, range of cart positions), so neither a huge
    (user, product) history nor one huge order is a task. All other lines meet in
    one window by (user, product): one shuffle and no join.
    """
    keys, order = ["user_id", "product_id"], ["order_number", "add_to_cart_order", "order_id"]

    def by_window(lines: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return lines.select(*base.columns, place.cast("long").alias(OCCURRENCE))

    def by_block(lines: DataFrame) -> DataFrame:
        return block_row_number(lines, keys, order, [F.col("order_number"), F.col("add_to_cart_order")],
                                [1, OCCURRENCE_BLOCK_LINES], OCCURRENCE)
    return by_group_size(base, "user_id", large_groups(base, "user_id", USER_LINES), by_window, by_block)


def occurrence_line_base(tables: Tables, scope: str = "train") -> DataFrame:
    """Line base with the occurrence number but without the per-user distinct
    product count: what the aggregates need (the count is added later from the
    user measures, where it is ``total_unique_product_by_user``). The joined lines
    are written first, so the joins run once. Product attributes are joined after the
    numbering, whose shuffle is without them; where a product id has several rows,
    which multiply its lines, before it."""
    repeated = tables.products.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        return with_occurrence_number(materialize(order_line_base(tables, scope), "joined_lines"))
    lines = with_occurrence_number(materialize(join_orders_lines(tables, scope), "joined_lines"))
    return with_product_attributes(lines, tables).select(*ORDER_COLS, *LINE_COLS, *PRODUCT_ATTR_COLS, OCCURRENCE)


def enriched_line_base(tables: Tables, scope: str = "train") -> DataFrame:
    """The line table every feature family is computed from (``df`` upstream).

    The numbered lines feed the per-user count and the join it returns to, so
    they are written once.
    """
    return with_user_unique_products(materialize(occurrence_line_base(tables, scope), "line_base"))


def _group_measures(prefix: str) -> list:
    return [
        F.avg("add_to_cart_order").alias(f"{prefix}mean_add_to_cart_order"),
        F.count(F.lit(1)).alias(f"{prefix}total_orders"),
        r_sum("reordered").alias(f"{prefix}total_reorders"),
        F.avg("reordered").alias(f"{prefix}reorder_percentage"),
    ]


def _unique_users(prefix: str) -> Column:
    return F.count_distinct("user_id").alias(f"{prefix}unique_users")


def product_features(base: DataFrame, whole: bool = True) -> DataFrame:
    """Seven measures per product.

    On a ``whole`` base each user's first purchase of a product is there, so the
    number of first purchases is the number of distinct users: a plain count
    without a shuffle of the lines. A filtered base needs the distinct count.
    """
    first = F.count_if(F.col(OCCURRENCE) == 1)
    return base.groupBy("product_id").agg(
        *_group_measures(""),
        first.alias("unique_users") if whole else _unique_users(""),
        first.alias("order_first_time_total_cnt"),
        F.count_if(F.col(OCCURRENCE) == 2).alias("order_second_time_total_cnt"),
    )


def aisle_features(base: DataFrame) -> DataFrame:
    """Five measures per aisle (a missing aisle is one group)."""
    return base.groupBy("aisle_id").agg(*_group_measures("aisle_"), _unique_users("aisle_"))


def department_features(base: DataFrame) -> DataFrame:
    """Five measures per department."""
    return base.groupBy("department_id").agg(*_group_measures("department_"), _unique_users("department_"))


def user_features(base: DataFrame, whole: bool = True) -> DataFrame:
    """Eleven measures per user (sd is NULL for a one-line user).

    On a ``whole`` base the distinct products are the first purchases, so one
    distinct count (orders) is left, which needs no expansion of the lines.
    """
    products = F.count_if(F.col(OCCURRENCE) == 1) if whole else F.count_distinct("product_id")
    return base.groupBy("user_id").agg(
        F.avg("order_dow").alias("avg_dow"),
        F.stddev_samp("order_dow").alias("std_dow"),
        F.avg("order_hour_of_day").alias("avg_doh"),
        F.stddev_samp("order_hour_of_day").alias("std_doh"),
        F.avg("days_since_prior_order").alias("avg_since_order"),
        F.stddev_samp("days_since_prior_order").alias("std_since_order"),
        F.count_distinct("order_number").alias("total_orders_by_user"),
        F.count(F.lit(1)).alias("total_products_by_user"),
        products.alias("total_unique_product_by_user"),
        r_sum("reordered").alias("total_reorders_by_user"),
        F.avg("reordered").alias("reorder_propotion_by_user"),
    )


def user_features_filled(base: DataFrame) -> DataFrame:
    """G6 + P2: the three sd columns with NULL set to 0."""
    return fill_zero(user_features(base), STD_COLS)


def product_attributes(base: DataFrame, tables: Tables, whole: bool = True) -> DataFrame:
    """Product measures with product, aisle and department attributes.

    Aisle and department keys can be NULL (a line whose product is unknown);
    those joins match NULL to NULL as the upstream joins do.
    """
    pf = product_features(base, whole)
    products = bounded_broadcast(tables.products.select("product_id", *PRODUCT_ATTR_COLS))
    out = pf.join(products, "product_id", "left")
    # aisle / department aggregates have at most one row per dimension key (+ NULL)
    out = null_safe_join(out, broadcast_bounded_by(aisle_features(base), tables.aisles), ["aisle_id"])
    out = null_safe_join(out, bounded_broadcast(tables.aisles.select("aisle_id", "aisle")), ["aisle_id"])
    out = null_safe_join(out, broadcast_bounded_by(department_features(base), tables.departments),
                         ["department_id"])
    out = null_safe_join(out, bounded_broadcast(tables.departments.select("department_id", "department")),
                         ["department_id"])
    return out.select("product_id", *PRODUCT_MEASURES, *PRODUCT_ATTR_COLS,
                      *[f"aisle_{m}" for m in GROUP_MEASURES], "aisle",
                      *[f"department_{m}" for m in GROUP_MEASURES], "department")


def product_feature_wide(base: DataFrame, tables: Tables, whole: bool = True) -> DataFrame:
    """Product attributes without name / aisle / department ids, aisle and department bit-encoded."""
    # one row per product: written so that the encoder's level count and the later
    # join read the small result instead of re-running the line-level plan
    attrs = materialize(product_attributes(base, tables, whole).drop(*PRODUCT_ATTR_COLS), "product_attributes")
    return binary_encode(attrs, ENCODED_COLS)


def product_lines_fanout(base: DataFrame, tables: Tables, lines: DataFrame) -> DataFrame:
    """Product attributes at the grain of the lines they were made from.

    Run from the line side (the reference starts from the attributes and joins
    the lines to them): both sides hold the same products, and a hot product's
    lines stay spread out while the small attribute table is broadcast.
    """
    attrs = product_attributes(base, tables)
    out = lines.join(broadcast_bounded_by(attrs, tables.products), "product_id", "inner")
    return out.select(*attrs.columns, *[c for c in lines.columns if c != "product_id"])


def product_base_suffix_join(base: DataFrame, tables: Tables) -> DataFrame:
    """Attributes joined to the line base, clashing names marked ``_x`` and ``_y``; from the line side as J12."""
    attrs = product_attributes(base, tables)
    clash = [x for x in attrs.columns if x in base.columns and x != "product_id"]
    left = attrs.select(*[F.col(x).alias(f"{x}_x") if x in clash else F.col(x) for x in attrs.columns])
    right = base.select(*[F.col(x).alias(f"{x}_y") if x in clash else F.col(x) for x in base.columns])
    out = right.join(broadcast_bounded_by(left, tables.products), "product_id", "inner")
    return out.select(*left.columns, *[c for c in right.columns if c != "product_id"])


def feature_table(tables: Tables, scope: str = "train", materialize_base: bool = True,
                  base: DataFrame | None = None, fit_on: Column | None = None) -> DataFrame:
    """One row per order line with product, aisle, department and user features.

    Steps as upstream: product features joined to the line table, user features
    joined by user, duplicate rows removed, NULL sd set to 0, ``order_id``,
    ``product_name``, ``aisle_id`` dropped and ``reordered`` moved last.

    Two rewrites that keep the result: (1) ``products LEFT JOIN lines`` is run
    as ``lines JOIN broadcast(products)``, since every product row came from
    the lines, so both sides hold the same product ids; (2) the full-row
    ``distinct()`` is a no-op and is not run, because two lines of one
    (user, product) always differ in ``user_buy_product_times`` and lines of
    different (user, product) differ in a key column. Skipping it saves a
    shuffle of the widest table in the plan.

    The enriched line table feeds five aggregates and the final join; with
    ``materialize_base`` it is written once to the shared checkpoint folder
    and every branch scans only the columns it needs. A ``base`` already
    built by :func:`enriched_line_base` can be passed in.

    ``fit_on`` (a boolean column, e.g. the training side of the split) turns
    off the label leakage of the upstream table: product, aisle, department
    and user measures are aggregated over the matching rows only and joined
    onto every row; rows whose product or user has no fitted row get NULL
    measures. Without it the measures use every row, as upstream.
    """
    if base is None:
        base = occurrence_line_base(tables, scope)
        if materialize_base:
            base = materialize(base, "line_base")
    if fit_on is not None and "unique_product_count" not in base.columns:
        # the distinct product count uses no label, so it stays over every line
        base = with_user_unique_products(base)
    fit = base if fit_on is None else base.filter(fit_on)
    wide = product_feature_wide(fit, tables, fit_on is None)
    # with every row fitted, each product of the lines has a row in ``wide``
    how = "inner" if fit_on is None else "left"
    return assemble(base, broadcast_bounded_by(wide, tables.products), user_features(fit, fit_on is None), how)


def assemble(base: DataFrame, wide: DataFrame, users: DataFrame, how: str = "inner") -> DataFrame:
    """E3, last steps: product features and user features joined to the lines, upstream's columns in its order."""
    # one join by user brings the user measures and the distinct product count
    # (the same number as total_unique_product_by_user), so the line table is
    # shuffled by user once, and before the product features make it wide
    if "unique_product_count" not in base.columns:
        users = users.withColumn("unique_product_count", F.col("total_unique_product_by_user"))
    out = base.join(users, "user_id", "left").join(wide, "product_id", how)
    line_cols = [c for c in base.columns if c not in ("product_id", "unique_product_count",
                                                      "user_buy_product_times")]
    out = out.select(*wide.columns, *line_cols, "unique_product_count", "user_buy_product_times", *USER_MEASURES)
    out = fill_zero(out, STD_COLS)
    out = out.drop("order_id", "product_name", "aisle_id")
    return out.select(*[c for c in out.columns if c != "reordered"], "reordered")
