"""DuckDB SQL that recomputes each registered query from the raw test tables.

Every statement starts from the pre-registered views ``orders``, ``lineitem``
and ``part`` and re-derives the five order tables with the same fixture rules
as :mod:`basketry.sources.fixtures`, written independently in SQL with plain
windows. Names are prefixed ``fx_`` so they never shadow the source views.
"""

from __future__ import annotations

from basketry.plans.registry import SKETCHED, STUMP_FEATURES, WHOLE_HISTORY

FIXTURE_CTES = r"""
fx_departments AS (
  SELECT CAST(row_number() OVER (ORDER BY department) AS BIGINT) AS department_id, department
  FROM (SELECT DISTINCT p_type AS department FROM part) t),
fx_aisles AS (
  SELECT DISTINCT CAST(regexp_extract(p_brand, '(\d+)', 1) AS BIGINT) AS aisle_id, p_brand AS aisle FROM part),
fx_part_products AS (
  SELECT p.p_partkey,
         CAST((CAST(regexp_extract(p.p_brand, '(\d+)', 1) AS INTEGER) - 1) * 6 + d.department_id AS BIGINT) AS product_id,
         concat_ws(' ', p.p_brand, p.p_type) AS product_name,
         CAST(regexp_extract(p.p_brand, '(\d+)', 1) AS BIGINT) AS aisle_id,
         d.department_id
  FROM part p JOIN fx_departments d ON p.p_type = d.department),
fx_products AS (
  SELECT DISTINCT product_id, product_name, aisle_id, department_id FROM fx_part_products),
fx_orders_w AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS odate,
         row_number() OVER w AS rn,
         count(*) OVER (PARTITION BY o_custkey) AS n_orders,
         lag(CAST(o_orderdate AS DATE)) OVER w AS prev_date
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)),
fx_orders AS (
  SELECT CAST(order_id AS BIGINT) AS order_id, CAST(user_id AS BIGINT) AS user_id,
         CASE WHEN rn = n_orders THEN 'train' ELSE 'prior' END AS eval_set,
         CAST(rn AS BIGINT) AS order_number,
         CAST(dayofweek(odate) AS BIGINT) AS order_dow,
         CAST(order_id % 24 AS BIGINT) AS order_hour_of_day,
         CASE WHEN prev_date IS NULL THEN NULL
              ELSE CAST(least(30, date_diff('day', prev_date, odate)) AS DOUBLE) END AS days_since_prior_order
  FROM fx_orders_w),
fx_lines_w AS (
  SELECT CAST(l.l_orderkey AS BIGINT) AS order_id, pp.product_id,
         CAST(row_number() OVER (PARTITION BY l.l_orderkey
              ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
                       l.l_shipdate, l.l_discount, l.l_tax) AS BIGINT) AS add_to_cart_order
  FROM lineitem l JOIN fx_part_products pp ON l.l_partkey = pp.p_partkey),
fx_lines_all AS (
  SELECT lw.order_id, lw.product_id, lw.add_to_cart_order,
         CAST(CASE WHEN o.order_number > min(o.order_number) OVER (PARTITION BY o.user_id, lw.product_id)
                   THEN 1 ELSE 0 END AS BIGINT) AS reordered,
         o.eval_set
  FROM fx_lines_w lw JOIN fx_orders o ON lw.order_id = o.order_id),
fx_op_train AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM fx_lines_all WHERE eval_set = 'train'),
fx_op_prior AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM fx_lines_all WHERE eval_set = 'prior')
"""


def lines_cte(scope: str) -> str:
    if scope == "train":
        return "fx_lines AS (SELECT * FROM fx_op_train)"
    if scope == "all":
        return "fx_lines AS (SELECT * FROM fx_op_prior UNION ALL SELECT * FROM fx_op_train)"
    raise ValueError(scope)


def with_fixture(scope: str, ctes: str, select: str) -> str:
    """``WITH <fixture tables>, fx_lines, <ctes> <select>``."""
    extra = f",\n{ctes.strip().rstrip(',')}" if ctes.strip() else ""
    return f"WITH {FIXTURE_CTES.strip()},\n{lines_cte(scope)}{extra}\n{select.strip()}"


# ---------------------------------------------------------------- shared SQL pieces
D = 9  # decimals of every double in the compared output


def r(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), {D}) AS {name}"


def div(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST({num} AS DOUBLE) / ({den}) END)"


BASE = """
fx_base0 AS (
  SELECT o.order_id, o.user_id, o.eval_set, o.order_number, o.order_dow, o.order_hour_of_day,
         coalesce(o.days_since_prior_order, 0.0) AS days_since_prior_order,
         l.product_id, l.add_to_cart_order, l.reordered, p.product_name, p.aisle_id, p.department_id
  FROM fx_orders o JOIN fx_lines l ON o.order_id = l.order_id
  LEFT JOIN fx_products p ON l.product_id = p.product_id),
fx_upc AS (SELECT user_id, count(DISTINCT product_id) AS unique_product_count FROM fx_base0 GROUP BY user_id),
fx_base AS (
  SELECT b.*, u.unique_product_count,
         row_number() OVER (PARTITION BY b.user_id, b.product_id
                            ORDER BY b.order_number, b.add_to_cart_order, b.order_id) AS user_buy_product_times
  FROM fx_base0 b LEFT JOIN fx_upc u ON b.user_id = u.user_id)
"""

BASE_COLS = ("order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order, "
             "product_id, add_to_cart_order, reordered, product_name, aisle_id, department_id")


def _group_measures(prefix: str) -> str:
    return (f"avg(add_to_cart_order) AS {prefix}mean_add_to_cart_order, count(*) AS {prefix}total_orders, "
            f"CAST(coalesce(sum(reordered), 0) AS BIGINT) AS {prefix}total_reorders, "
            f"avg(reordered) AS {prefix}reorder_percentage, count(DISTINCT user_id) AS {prefix}unique_users")


PRODUCT_MEASURES = ["mean_add_to_cart_order", "total_orders", "total_reorders", "reorder_percentage",
                    "unique_users", "order_first_time_total_cnt", "order_second_time_total_cnt"]
GROUP_MEASURES = ["mean_add_to_cart_order", "total_orders", "total_reorders", "reorder_percentage", "unique_users"]
DOUBLE_MEASURES = {"mean_add_to_cart_order", "reorder_percentage"}
USER_MEASURES = ["avg_dow", "std_dow", "avg_doh", "std_doh", "avg_since_order", "std_since_order",
                 "total_orders_by_user", "total_products_by_user", "total_unique_product_by_user",
                 "total_reorders_by_user", "reorder_propotion_by_user"]
USER_DOUBLES = {"avg_dow", "std_dow", "avg_doh", "std_doh", "avg_since_order", "std_since_order",
                "reorder_propotion_by_user"}
AISLE_BITS, DEPARTMENT_BITS = 5, 3  # 25 brands and 6 part types in every fixture scale

AGGS = f"""
fx_pf AS (
  SELECT product_id, {_group_measures('')},
         CAST(count_if(user_buy_product_times = 1) AS BIGINT) AS order_first_time_total_cnt,
         CAST(count_if(user_buy_product_times = 2) AS BIGINT) AS order_second_time_total_cnt
  FROM fx_base GROUP BY product_id),
fx_af AS (SELECT aisle_id, {_group_measures('aisle_')} FROM fx_base GROUP BY aisle_id),
fx_df AS (SELECT department_id, {_group_measures('department_')} FROM fx_base GROUP BY department_id),
fx_uf AS (
  SELECT user_id, avg(order_dow) AS avg_dow, stddev_samp(order_dow) AS std_dow,
         avg(order_hour_of_day) AS avg_doh, stddev_samp(order_hour_of_day) AS std_doh,
         avg(days_since_prior_order) AS avg_since_order, stddev_samp(days_since_prior_order) AS std_since_order,
         count(DISTINCT order_number) AS total_orders_by_user, count(*) AS total_products_by_user,
         count(DISTINCT product_id) AS total_unique_product_by_user,
         CAST(coalesce(sum(reordered), 0) AS BIGINT) AS total_reorders_by_user,
         avg(reordered) AS reorder_propotion_by_user
  FROM fx_base GROUP BY user_id),
fx_pattr AS (
  SELECT pf.*, p.product_name, p.aisle_id, p.department_id,
         af.aisle_mean_add_to_cart_order, af.aisle_total_orders, af.aisle_total_reorders,
         af.aisle_reorder_percentage, af.aisle_unique_users, a.aisle,
         df.department_mean_add_to_cart_order, df.department_total_orders, df.department_total_reorders,
         df.department_reorder_percentage, df.department_unique_users, d.department
  FROM fx_pf pf
  LEFT JOIN fx_products p ON pf.product_id = p.product_id
  LEFT JOIN fx_af af ON af.aisle_id IS NOT DISTINCT FROM p.aisle_id
  LEFT JOIN fx_aisles a ON a.aisle_id IS NOT DISTINCT FROM p.aisle_id
  LEFT JOIN fx_df df ON df.department_id IS NOT DISTINCT FROM p.department_id
  LEFT JOIN fx_departments d ON d.department_id IS NOT DISTINCT FROM p.department_id),
fx_codes AS (
  SELECT *,
         CASE WHEN aisle IS NULL THEN 0 ELSE dense_rank() OVER (ORDER BY aisle) END AS aisle_code,
         CASE WHEN department IS NULL THEN 0 ELSE dense_rank() OVER (ORDER BY department) END AS department_code,
         greatest(1, CAST(ceil(log2((SELECT count(DISTINCT coalesce(aisle, chr(0))) FROM fx_pattr))) AS BIGINT))
           AS aisle_w,
         greatest(1, CAST(ceil(log2((SELECT count(DISTINCT coalesce(department, chr(0))) FROM fx_pattr))) AS BIGINT))
           AS department_w
  FROM fx_pattr),
fx_pw AS (
  SELECT product_id, {', '.join(PRODUCT_MEASURES)},
         {', '.join('aisle_' + m for m in GROUP_MEASURES)},
         {', '.join('department_' + m for m in GROUP_MEASURES)},
         {', '.join(f'CAST((aisle_code >> (aisle_w - {i})) & 1 AS BIGINT) AS aisle_bin_{i}'
                    for i in range(1, AISLE_BITS + 1))},
         {', '.join(f'CAST((department_code >> (department_w - {i})) & 1 AS BIGINT) AS department_bin_{i}'
                    for i in range(1, DEPARTMENT_BITS + 1))}
  FROM fx_codes),
fx_ft AS (
  SELECT DISTINCT pw.*, b.user_id, b.eval_set, b.order_number, b.order_dow, b.order_hour_of_day,
         b.days_since_prior_order, b.add_to_cart_order, b.department_id, b.unique_product_count,
         b.user_buy_product_times,
         uf.avg_dow, coalesce(uf.std_dow, 0.0) AS std_dow, uf.avg_doh, coalesce(uf.std_doh, 0.0) AS std_doh,
         uf.avg_since_order, coalesce(uf.std_since_order, 0.0) AS std_since_order,
         uf.total_orders_by_user, uf.total_products_by_user, uf.total_unique_product_by_user,
         uf.total_reorders_by_user, uf.reorder_propotion_by_user, b.reordered,
         b.order_id AS _order_id
  FROM fx_pw pw LEFT JOIN fx_base b ON pw.product_id = b.product_id
  LEFT JOIN fx_uf uf ON b.user_id = uf.user_id),
fx_hold AS (
  SELECT *, CASE WHEN reorder_propotion_by_user >= @threshold THEN 1 ELSE 0 END AS prediction
  FROM fx_ft
  WHERE ((user_id * 7919 + order_number * 104729 + product_id * 31 + add_to_cart_order * 17) % 100) >= 80)
"""

THRESHOLDS = {"train": "0.7", "all": "0.25"}
BUCKET = "((user_id * 7919 + order_number * 104729 + product_id * 31 + add_to_cart_order * 17) % 100)"

# measures of the training side only, joined onto every line
_before, _after = AGGS.split("fx_ft AS (")
FITTED = (f"fx_fit AS (SELECT * FROM fx_base WHERE {BUCKET} < 80)," + _before.replace("FROM fx_base GROUP", "FROM fx_fit GROUP")
          + "fx_ft AS (" + _after.split("),\nfx_hold")[0].replace("SELECT DISTINCT pw.*", "SELECT pw.* EXCLUDE (product_id), b.product_id")
          .replace("FROM fx_pw pw LEFT JOIN fx_base b ON pw.product_id = b.product_id",
                   "FROM fx_base b LEFT JOIN fx_pw pw ON pw.product_id = b.product_id") + ")")

FT_DOUBLES = (DOUBLE_MEASURES | {f"aisle_{m}" for m in DOUBLE_MEASURES} | {f"department_{m}" for m in DOUBLE_MEASURES}
              | USER_DOUBLES | {"days_since_prior_order"})
FT_COLS = (["product_id", *PRODUCT_MEASURES, *[f"aisle_{m}" for m in GROUP_MEASURES],
            *[f"department_{m}" for m in GROUP_MEASURES],
            *[f"aisle_bin_{i}" for i in range(1, AISLE_BITS + 1)],
            *[f"department_bin_{i}" for i in range(1, DEPARTMENT_BITS + 1)],
            "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order",
            "add_to_cart_order", "department_id", "unique_product_count", "user_buy_product_times",
            *USER_MEASURES, "reordered"])


def select_cols(cols, doubles, src: str = "", prefix: str = "") -> str:
    out = []
    for c in cols:
        ref = f"{prefix}{c}"
        out.append(r(ref, c) if c in doubles else f"{ref} AS {c}")
    return ", ".join(out)


RULES = """
fx_freq AS (SELECT product_id, count(*) AS frequency FROM fx_lines GROUP BY product_id),
fx_top AS (SELECT product_id, frequency FROM fx_freq ORDER BY frequency DESC, product_id LIMIT 100),
fx_fl AS (SELECT l.* FROM fx_lines l WHERE l.product_id IN (SELECT product_id FROM fx_top)),
fx_fln AS (SELECT l.*, p.product_name, p.aisle_id, p.department_id
           FROM fx_fl l LEFT JOIN fx_products p ON l.product_id = p.product_id),
fx_oi AS (SELECT DISTINCT order_id, product_name AS item FROM fx_fln WHERE product_name IS NOT NULL),
fx_n AS (SELECT count(DISTINCT order_id) AS n FROM fx_oi),
fx_ic AS (SELECT item, count(*) AS c FROM fx_oi GROUP BY item),
fx_pc AS (SELECT a.item AS x, b.item AS y, count(*) AS c
          FROM fx_oi a JOIN fx_oi b ON a.order_id = b.order_id AND a.item <> b.item GROUP BY a.item, b.item),
fx_rules_all AS (
  SELECT pc.x, pc.y, '{' || pc.x || '}' AS lhs, '{' || pc.y || '}' AS rhs,
         CAST(pc.c AS DOUBLE) / n AS support, CAST(pc.c AS DOUBLE) / ix.c AS confidence,
         CAST(pc.c * n AS DOUBLE) / CAST(ix.c * iy.c AS DOUBLE) AS lift,
         CAST(ix.c AS DOUBLE) / n AS coverage, CAST(pc.c AS BIGINT) AS count
  FROM fx_pc pc JOIN fx_ic ix ON ix.item = pc.x JOIN fx_ic iy ON iy.item = pc.y CROSS JOIN fx_n
  WHERE pc.c >= ceil(CAST(0.001 AS DOUBLE) * n)),
fx_rules AS (SELECT * FROM fx_rules_all WHERE confidence >= 0.05)
"""

# Itemsets up to 4 items by ordered self-joins of the frequent (order, item) rows inside baskets.
# At the check scale no frequent itemset has more than 2 items, so the bound is not reached; a
# larger frequent itemset found by the miner would show up as a mismatch, not be hidden.
ITEMSETS = """,
fx_minc AS (SELECT ceil(CAST(0.001 AS DOUBLE) * n) AS m FROM fx_n),
fx_i1 AS (SELECT item AS i1, count(*) AS c FROM fx_oi GROUP BY item
          HAVING count(*) >= (SELECT m FROM fx_minc)),
fx_f1 AS (SELECT o.order_id, o.item FROM fx_oi o JOIN fx_i1 f ON o.item = f.i1),
fx_i2 AS (SELECT a.item AS i1, b.item AS i2, count(*) AS c
          FROM fx_f1 a JOIN fx_f1 b ON a.order_id = b.order_id AND a.item < b.item
          GROUP BY 1, 2 HAVING count(*) >= (SELECT m FROM fx_minc)),
fx_i3 AS (SELECT a.item AS i1, b.item AS i2, c.item AS i3, count(*) AS c
          FROM fx_f1 a JOIN fx_f1 b ON a.order_id = b.order_id AND a.item < b.item
          JOIN fx_f1 c ON c.order_id = a.order_id AND b.item < c.item
          GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT m FROM fx_minc)),
fx_i4 AS (SELECT a.item AS i1, b.item AS i2, c.item AS i3, d.item AS i4, count(*) AS c
          FROM fx_f1 a JOIN fx_f1 b ON a.order_id = b.order_id AND a.item < b.item
          JOIN fx_f1 c ON c.order_id = a.order_id AND b.item < c.item
          JOIN fx_f1 d ON d.order_id = a.order_id AND c.item < d.item
          GROUP BY 1, 2, 3, 4 HAVING count(*) >= (SELECT m FROM fx_minc)),
fx_sets AS (SELECT [i1] AS items, c FROM fx_i1
            UNION ALL SELECT [i1, i2], c FROM fx_i2
            UNION ALL SELECT [i1, i2, i3], c FROM fx_i3
            UNION ALL SELECT [i1, i2, i3, i4], c FROM fx_i4),
fx_parts AS (SELECT items, c AS cs, unnest(items) AS y FROM fx_sets WHERE len(items) >= 2),
fx_fp AS (SELECT list_filter(items, lambda x: x <> y) AS ant, y, cs FROM fx_parts),
fx_fp_rules AS (
  SELECT r.ant, r.y, '{' || array_to_string(r.ant, ',') || '}' AS lhs, '{' || r.y || '}' AS rhs,
         CAST(r.cs AS DOUBLE) / n AS support,
         CAST(r.cs AS DOUBLE) / sx.c AS confidence,
         (CAST(r.cs AS DOUBLE) / sx.c) / (CAST(iy.c AS DOUBLE) / n) AS lift,
         (CAST(r.cs AS DOUBLE) / n) / (CAST(r.cs AS DOUBLE) / sx.c) AS coverage,
         CAST(r.cs AS BIGINT) AS count
  FROM fx_fp r JOIN fx_sets sx ON sx.items = r.ant JOIN fx_i1 iy ON iy.i1 = r.y CROSS JOIN fx_n
  WHERE CAST(r.cs AS DOUBLE) / sx.c >= 0.05)
"""

RULE_OUT = (f"lhs, rhs, {r('support', 'support')}, {r('confidence', 'confidence')}, {r('lift', 'lift')}, "
            f"{r('coverage', 'coverage')}, count")

PATTR_COLS = ["product_id", *PRODUCT_MEASURES, "product_name", "aisle_id", "department_id",
              *[f"aisle_{m}" for m in GROUP_MEASURES], "aisle", *[f"department_{m}" for m in GROUP_MEASURES],
              "department"]
PATTR_DOUBLES = DOUBLE_MEASURES | {f"aisle_{m}" for m in DOUBLE_MEASURES} | {f"department_{m}" for m in DOUBLE_MEASURES}
BASE_ALL = BASE_COLS.split(", ") + ["unique_product_count", "user_buy_product_times"]


def _nulls_sql(cols: list[tuple[str, bool]], src: str) -> str:
    parts = []
    for c, is_double in cols:
        cond = f"{c} IS NULL OR isnan({c})" if is_double else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS \"column\", CAST(count_if({cond}) AS BIGINT) AS na_count FROM {src}")
    return " UNION ALL ".join(parts)


# Spark's types of the feature table's columns; the others are bigint
SCHEMA_INTS = ("order_number", "order_dow", "order_hour_of_day", "add_to_cart_order", "department_id", "reordered")


def _schema_sql(cols: list[str], doubles, src: str) -> str:
    parts = []
    for i, c in enumerate(cols):
        kind = ("double" if c in doubles else "string" if c == "eval_set"
                else "int" if c in SCHEMA_INTS or "_bin_" in c else "bigint")
        parts.append(f"SELECT CAST({i + 1} AS BIGINT) AS position, '{c}' AS \"column\", '{kind}' AS type, "
                     f"count({c}) AS n_values FROM {src}")
    return " UNION ALL ".join(parts)


# the columns of the order tables: whole numbers (z), numbers (d), text (s)
FOUND_COLS = {
    "orders": ("fx_orders", "order_id z, user_id z, eval_set s, order_number z, order_dow z, order_hour_of_day z, "
                            "days_since_prior_order d"),
    "products": ("fx_products", "product_id z, product_name s, aisle_id z, department_id z"),
    "aisles": ("fx_aisles", "aisle_id z, aisle s"),
    "departments": ("fx_departments", "department_id z, department s"),
    "order_products_train": ("fx_op_train", "order_id z, product_id z, add_to_cart_order z, reordered z"),
    "order_products_prior": ("fx_op_prior", "order_id z, product_id z, add_to_cart_order z, reordered z"),
}


def _found_sql() -> str:
    """The narrowest type of each column by the range of its values."""
    parts = []
    for name, (src, cols) in FOUND_COLS.items():
        for i, col in enumerate(cols.split(", ")):
            c, kind = col.split()
            held = {"z": f"CASE WHEN min({c}) < -2147483648 OR max({c}) > 2147483647 THEN 'bigint' ELSE 'int' END",
                    "d": "'double'", "s": "'string'"}[kind]
            parts.append(f"SELECT '{name}' AS \"table\", CAST({i + 1} AS BIGINT) AS position, '{c}' AS \"column\", "
                         f"CASE WHEN count({c}) = 0 THEN 'boolean' ELSE {held} END AS type, "
                         f"count(*) - count({c}) AS n_missing FROM {src}")
    return " UNION ALL ".join(parts)


def _stump_sql() -> str:
    """One split over all rows: squared error, first score 0.5, L2 term 1, step 0.3, one row a side at least."""
    values = " UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature, CAST({c} AS DOUBLE) AS v, 0.5 - reordered AS g FROM fx_tr"
                                for i, c in enumerate(STUMP_FEATURES))
    return f"""
fx_tr AS (SELECT * FROM fx_ft WHERE {BUCKET} < 80),
fx_sv AS (SELECT f, feature, v, CAST(sum(g) AS DOUBLE) AS g, count(*) AS h FROM ({values}) GROUP BY f, feature, v),
fx_sc AS (SELECT f, feature, v, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY f) AS g,
                 sum(h) OVER (PARTITION BY f) AS h, max(v) OVER (PARTITION BY f) AS top
          FROM fx_sv WINDOW w AS (PARTITION BY f ORDER BY v)),
fx_sb AS (SELECT *, gl * gl / (hl + 1.0) + (g - gl) * (g - gl) / (h - hl + 1.0) - g * g / (h + 1.0) AS gain
          FROM fx_sc WHERE v < top ORDER BY gain DESC, f, v LIMIT 1)"""


def oracle_statements() -> dict[str, str]:
    """One statement per key; the scoped keys once more over the whole history, as ``<key>_all``."""
    whole = _statements("all")
    return _statements("train") | {f"{name}_all": whole[name] for name in WHOLE_HISTORY if name in whole}


def _statements(scope: str) -> dict[str, str]:
    T, A = scope, "all"
    ft = with_fixture  # shorthand
    base_ctes = BASE
    feat_ctes = BASE + "," + AGGS.replace("@threshold", THRESHOLDS[scope])
    q: dict[str, str] = {}

    # sources
    q["scan_orders"] = ft(A, "", "SELECT * FROM fx_orders")
    q["scan_products"] = ft(A, "", "SELECT * FROM fx_products")
    q["scan_departments"] = ft(A, "", "SELECT * FROM fx_departments")
    q["scan_aisles"] = ft(A, "", "SELECT * FROM fx_aisles")
    q["scan_order_products_train"] = ft(A, "", "SELECT * FROM fx_op_train")
    q["scan_order_products_all"] = ft(A, "", "SELECT * FROM fx_lines")
    ft_select = f"SELECT {select_cols(FT_COLS, FT_DOUBLES)} FROM fx_ft"
    q["feature_table"] = ft(T, feat_ctes, ft_select)
    q["feature_table_roundtrip"] = q["feature_table"]

    # profiling
    shape_parts = [
        ("orders", "fx_orders", 7), ("products", "fx_products", 4), ("aisles", "fx_aisles", 2),
        ("departments", "fx_departments", 2), ("order_products_train", "fx_op_train", 4),
        ("order_products_prior", "fx_op_prior", 4), ("top_products", "fx_top", 5),
        ("frequent_order_lines", "fx_fln", 7)]
    q["profile_shape"] = ft(A, RULES, " UNION ALL ".join(
        f"SELECT '{n}' AS \"table\", count(*) AS n_rows, CAST({k} AS BIGINT) AS n_cols FROM {src}"
        for n, src, k in shape_parts))
    q["profile_nulls"] = ft(T, base_ctes, _nulls_sql(
        [(c, c == "days_since_prior_order") for c in BASE_COLS.split(", ")], "fx_base0"))
    q["profile_on_write"] = ft(T, base_ctes, f"SELECT *, (SELECT count(*) FROM fx_base0) AS n_rows FROM ({_nulls_sql(
        [(c, c == 'days_since_prior_order') for c in BASE_COLS.split(', ')], 'fx_base0')})")
    q["profile_schema"] = ft(T, feat_ctes, _schema_sql(FT_COLS, FT_DOUBLES, "fx_ft"))
    q["csv_found_types"] = ft(A, "", _found_sql())
    q["preview_head"] = ft(T, base_ctes, f"SELECT {select_cols(BASE_COLS.split(', '), {'days_since_prior_order'})} "
                                         "FROM fx_base0 ORDER BY order_id, add_to_cart_order LIMIT 6")

    # projections / filters
    q["fill_days_since_prior"] = ft(A, "", "SELECT order_id, user_id, eval_set, order_number, order_dow, "
                                           "order_hour_of_day, coalesce(days_since_prior_order, 0.0) AS "
                                           "days_since_prior_order FROM fx_orders")
    uf_sel = ", ".join(
        (r(f"coalesce({c}, 0.0)", c) if c.startswith("std_") else r(c, c)) if c in USER_DOUBLES else c
        for c in USER_MEASURES)
    q["user_features_filled"] = ft(T, feat_ctes, f"SELECT user_id, {uf_sel} FROM fx_uf")
    q["user_features"] = ft(T, feat_ctes, f"SELECT user_id, {select_cols(USER_MEASURES, USER_DOUBLES)} FROM fx_uf")
    q["freq_order_lines"] = ft(A, RULES, "SELECT order_id, product_id, add_to_cart_order, reordered FROM fx_fl")
    names = "fx_names AS (SELECT row_number() OVER (ORDER BY product_name) AS rk, product_name " \
            "FROM (SELECT DISTINCT product_name FROM fx_fln WHERE product_name IS NOT NULL) t)"
    cells = ", ".join(f"coalesce(bool_or(n.rk = {i}), false) AS item_{i:03d}" for i in range(1, 101))
    q["basket_incidence"] = ft(A, RULES + ",\n" + names, f"""
SELECT l.order_id, {cells}
FROM fx_fln l LEFT JOIN fx_names n ON l.product_name = n.product_name GROUP BY l.order_id""")
    q["basket_item_names"] = ft(A, RULES + ",\n" + names, "SELECT CAST(rk AS BIGINT) AS item, product_name FROM fx_names")
    q["rules_lift_gt1"] = ft(A, RULES + ITEMSETS, f"SELECT {RULE_OUT} FROM fx_fp_rules WHERE lift > 1")
    q["threshold_predictions"] = ft(T, feat_ctes, "SELECT user_id, order_number, product_id, add_to_cart_order, "
                                                  f"reordered, {r('reorder_propotion_by_user', 'reorder_propotion_by_user')}, "
                                                  "CAST(prediction AS BIGINT) AS prediction FROM fx_hold")
    share = "CAST(contagem * 100 AS DOUBLE) / sum(contagem) OVER ()"
    q["outcome_share"] = ft(T, feat_ctes, f"""
SELECT sucesso, contagem, round(round_even({share}, 2), {D}) AS acertos_pct,
       regexp_replace(printf('%.2f', round_even({share}, 2)), '\\.?0+$', '') || ' %' AS acertos_texto
FROM (SELECT CASE WHEN reordered = prediction THEN 'sim' ELSE 'não' END AS sucesso, count(*) AS contagem
      FROM fx_hold GROUP BY 1) t""")
    q["predicted_products"] = ft(T, feat_ctes, """
SELECT h.user_id, string_agg(p.product_name, ', ' ORDER BY h.product_id) AS produtos_previstos
FROM fx_hold h JOIN fx_products p ON h.product_id = p.product_id WHERE h.prediction = 1 GROUP BY h.user_id""")
    q["actual_products"] = ft(T, feat_ctes, """
SELECT h.user_id, string_agg(p.product_name, ', ' ORDER BY h.product_id) AS produtos_reais
FROM fx_hold h JOIN fx_products p ON h.product_id = p.product_id WHERE h.reordered = 1 GROUP BY h.user_id""")
    q["predicted_vs_actual"] = ft(T, feat_ctes + """,
fx_pred AS (SELECT h.user_id, string_agg(p.product_name, ', ' ORDER BY h.product_id) AS produtos_previstos
            FROM fx_hold h JOIN fx_products p ON h.product_id = p.product_id WHERE h.prediction = 1
            GROUP BY h.user_id),
fx_real AS (SELECT h.user_id, string_agg(p.product_name, ', ' ORDER BY h.product_id) AS produtos_reais
            FROM fx_hold h JOIN fx_products p ON h.product_id = p.product_id WHERE h.reordered = 1
            GROUP BY h.user_id)""",
                                  "SELECT a.user_id, a.produtos_previstos, b.produtos_reais "
                                  "FROM fx_pred a JOIN fx_real b ON a.user_id = b.user_id")
    q["submission_list"] = ft(T, feat_ctes, """
SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ' ' ORDER BY product_id) AS produtos
FROM fx_hold WHERE prediction = 1 GROUP BY user_id""")

    # joins
    q["join_orders_lines"] = ft(T, base_ctes, "SELECT order_id, user_id, eval_set, order_number, order_dow, "
                                              "order_hour_of_day, days_since_prior_order, product_id, "
                                              "add_to_cart_order, reordered FROM fx_base0")
    q["order_line_base"] = ft(T, base_ctes, f"SELECT {BASE_COLS} FROM fx_base0")
    q["lines_with_products"] = ft(A, "", "SELECT l.order_id, l.product_id, l.add_to_cart_order, l.reordered, "
                                         "p.product_name, p.aisle_id, p.department_id FROM fx_lines l "
                                         "LEFT JOIN fx_products p ON l.product_id = p.product_id")
    q["freq_lines_with_products"] = ft(A, RULES, "SELECT order_id, product_id, add_to_cart_order, reordered, "
                                                 "product_name, aisle_id, department_id FROM fx_fln")
    q["top_products"] = ft(A, RULES, "SELECT t.product_id, t.frequency, p.product_name, p.aisle_id, "
                                     "p.department_id FROM fx_top t LEFT JOIN fx_products p "
                                     "ON t.product_id = p.product_id")
    q["user_unique_products"] = ft(T, base_ctes, f"SELECT {BASE_COLS}, unique_product_count FROM fx_base")
    pw_cols = ["product_id", *PRODUCT_MEASURES, *[f"aisle_{m}" for m in GROUP_MEASURES],
               *[f"department_{m}" for m in GROUP_MEASURES],
               *[f"aisle_bin_{i}" for i in range(1, AISLE_BITS + 1)],
               *[f"department_bin_{i}" for i in range(1, DEPARTMENT_BITS + 1)]]
    q["product_feature_wide"] = ft(T, feat_ctes, f"SELECT {select_cols(pw_cols, PATTR_DOUBLES)} FROM fx_pw")
    q["binary_encode"] = ft(T, feat_ctes, "SELECT product_id, " + ", ".join(pw_cols[-(AISLE_BITS + DEPARTMENT_BITS):])
                            + " FROM fx_pw")
    q["product_lines_fanout"] = ft(T, feat_ctes, f"SELECT {select_cols(PATTR_COLS, PATTR_DOUBLES, prefix='a.')}, "
                                                 "l.order_id, l.add_to_cart_order, l.reordered FROM fx_pattr a "
                                                 "LEFT JOIN fx_lines l ON a.product_id = l.product_id")
    clash = {"product_name", "aisle_id", "department_id"}
    left = [(f"a.{c}", f"{c}_x" if c in clash else c, c in PATTR_DOUBLES) for c in PATTR_COLS]
    right = [(f"b.{c}", f"{c}_y" if c in clash else c, c == "days_since_prior_order")
             for c in BASE_ALL if c != "product_id"]
    sel = ", ".join(r(e, n) if dbl else f"{e} AS {n}" for e, n, dbl in left + right)
    q["product_base_suffix_join"] = ft(T, feat_ctes, f"SELECT {sel} FROM fx_pattr a LEFT JOIN fx_base b "
                                                     "ON a.product_id = b.product_id")
    bucket = BUCKET
    q["split_holdout"] = ft(T, feat_ctes, f"{ft_select} WHERE {bucket} >= 80")
    q["split_train"] = ft(T, feat_ctes, f"{ft_select} WHERE {bucket} < 80")
    q["split_balance"] = ft(T, feat_ctes, f"""
SELECT CASE WHEN {bucket} < 80 THEN 'train' ELSE 'holdout' END AS part, count(*) AS n_rows,
       {r('avg(reordered)', 'label_share')} FROM fx_ft GROUP BY 1""")

    q["split_stratified_balance"] = ft(T, feat_ctes, """
SELECT 'train' AS part, reordered, CAST(ceil(count(*) * 80 / 100.0) AS BIGINT) AS n_rows FROM fx_ft GROUP BY reordered
UNION ALL
SELECT 'holdout' AS part, reordered, CAST(count(*) - ceil(count(*) * 80 / 100.0) AS BIGINT) AS n_rows
FROM fx_ft GROUP BY reordered""")

    # aggregations / window
    q["product_frequency"] = ft(A, RULES, "SELECT product_id, frequency FROM fx_freq")
    q["product_features"] = ft(T, feat_ctes, f"SELECT {select_cols(['product_id', *PRODUCT_MEASURES], DOUBLE_MEASURES)} "
                                             "FROM fx_pf")
    q["aisle_features"] = ft(T, feat_ctes, "SELECT " + select_cols(
        ["aisle_id", *[f"aisle_{m}" for m in GROUP_MEASURES]], PATTR_DOUBLES) + " FROM fx_af")
    q["department_features"] = ft(T, feat_ctes, "SELECT " + select_cols(
        ["department_id", *[f"department_{m}" for m in GROUP_MEASURES]], PATTR_DOUBLES) + " FROM fx_df")
    q["sketched_distinct"] = ft(T, base_ctes, " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, CAST({by} AS BIGINT) AS id, count(DISTINCT {value}) AS n, TRUE AS close "
        f"FROM fx_base GROUP BY {by}" for kind, by, value in SKETCHED))
    q["user_buy_product_times"] = ft(T, base_ctes, "SELECT order_id, user_id, product_id, order_number, "
                                                   "add_to_cart_order, user_buy_product_times FROM fx_base")
    q["confusion_counts"] = ft(T, feat_ctes, """
SELECT CAST(g.prediction AS BIGINT) AS prediction, CAST(g.reference AS BIGINT) AS reference,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(prediction, reference)
LEFT JOIN (SELECT prediction, reordered AS reference, count(*) AS n FROM fx_hold GROUP BY 1, 2) c
  ON g.prediction = c.prediction AND g.reference = c.reference""")
    a, b, c, d = "a", "b", "c", "d"
    n = "(a + b + c + d)"
    acc = div("a + d", n)
    pe = div("(a + b) * (a + c) + (c + d) * (b + d)", f"{n} * {n}")
    sens, spec = div("a", "a + c"), div("d", "b + d")
    q["model_stump"] = ft(T, feat_ctes + "," + _stump_sql(), f"""
SELECT CAST(0 AS BIGINT) AS tree, CAST(1 AS BIGINT) AS node, '' AS feature, CAST(0 AS DOUBLE) AS cut,
       CAST(0.5 AS DOUBLE) AS leaf, CAST(0 AS DOUBLE) AS gain, CAST(0 AS BIGINT) AS n_rows
UNION ALL SELECT 1, 1, feature, v, 0, {r('gain', 'gain')}, CAST(h AS BIGINT) FROM fx_sb
UNION ALL SELECT 1, 2, '', 0, round(-gl / (hl + 1.0) * CAST(0.3 AS DOUBLE), {D}), 0, CAST(hl AS BIGINT) FROM fx_sb
UNION ALL SELECT 1, 3, '', 0, round(-(g - gl) / (h - hl + 1.0) * CAST(0.3 AS DOUBLE), {D}), 0,
                 CAST(h - hl AS BIGINT) FROM fx_sb""")
    q["confusion_metrics"] = ft(T, feat_ctes, f"""
SELECT CAST(0 AS BIGINT) AS positive, CAST({n} AS BIGINT) AS n,
       {r(acc, 'accuracy')},
       {r(div('greatest(a + c, b + d)', n), 'no_information_rate')},
       {r(div(f'{acc} - {pe}', f'1 - {pe}'), 'kappa')},
       {r(sens, 'sensitivity')}, {r(spec, 'specificity')},
       {r(div('a', 'a + b'), 'pos_pred_value')}, {r(div('d', 'c + d'), 'neg_pred_value')},
       {r(div('a + c', n), 'prevalence')}, {r(div('a', n), 'detection_rate')},
       {r(div('a + b', n), 'detection_prevalence')},
       {r(f'({sens} + {spec}) / 2', 'balanced_accuracy')},
       {r(div('(CASE WHEN b = c THEN 0 ELSE (abs(b - c) - 1) * (abs(b - c) - 1) END)', 'b + c'), 'mcnemar_statistic')}
FROM (SELECT CAST(count_if(prediction = 0 AND reordered = 0) AS DOUBLE) AS a,
             CAST(count_if(prediction = 0 AND reordered = 1) AS DOUBLE) AS b,
             CAST(count_if(prediction = 1 AND reordered = 0) AS DOUBLE) AS c,
             CAST(count_if(prediction = 1 AND reordered = 1) AS DOUBLE) AS d FROM fx_hold) m""")

    # baskets and rules
    q["baskets"] = ft(A, RULES, "SELECT order_id, string_agg(item, ', ' ORDER BY item) AS items "
                                "FROM fx_oi GROUP BY order_id")
    q["frequent_pairs"] = ft(A, RULES, f"SELECT x || ', ' || y AS items, count AS freq, {r('support', 'support')} "
                                       "FROM fx_rules_all WHERE x < y")
    q["pair_rules"] = ft(A, RULES, f"SELECT {RULE_OUT} FROM fx_rules")
    q["frequent_itemsets"] = ft(A, RULES + ITEMSETS, f"SELECT array_to_string(items, ', ') AS items, "
                                                     f"CAST(c AS BIGINT) AS freq, {r('CAST(c AS DOUBLE) / n', 'support')} "
                                                     "FROM fx_sets CROSS JOIN fx_n")
    q["association_rules"] = ft(A, RULES + ITEMSETS, f"SELECT {RULE_OUT} FROM fx_fp_rules")
    q["apriori_itemsets"], q["apriori_rules"] = q["frequent_itemsets"], q["association_rules"]
    q["top_rules"] = ft(A, RULES + ITEMSETS, f"SELECT {RULE_OUT} FROM fx_fp_rules WHERE lift > 1 ORDER BY lift DESC, "
                                             "support DESC, array_to_string(ant, chr(1)), y LIMIT 5")
    q["top_pair_rules"] = ft(A, RULES, f"SELECT {RULE_OUT} FROM fx_rules WHERE lift > 1 "
                                       "ORDER BY lift DESC, support DESC, x, y LIMIT 5")
    q["rule_scatter"] = ft(A, RULES + ITEMSETS, f"SELECT lhs, rhs, {r('support', 'support')}, {r('lift', 'lift')}, "
                                                f"{r('confidence', 'confidence')} FROM fx_fp_rules")
    q["rule_graph_edges"] = ft(A, RULES + ITEMSETS, f"""
SELECT lhs || ' => ' || rhs AS rule, unnest(ant) AS item, 'item_to_rule' AS direction, {r('support', 'support')},
       {r('lift', 'lift')} FROM fx_fp_rules
UNION ALL
SELECT lhs || ' => ' || rhs AS rule, y AS item, 'rule_to_item' AS direction, {r('support', 'support')},
       {r('lift', 'lift')} FROM fx_fp_rules""")
    q["rule_matrix"] = ft(A, RULES + ITEMSETS, f"SELECT lhs, rhs, {r('lift', 'lift')} FROM fx_fp_rules")
    q["feature_table_fitted"] = ft(T, BASE + "," + FITTED, f"SELECT {select_cols(FT_COLS, FT_DOUBLES)} FROM fx_ft")
    hashed = ("((user_id * 7919 + order_number * 104729 + product_id * 31 + add_to_cart_order * 17) % 2147483647 "
              "* 1103515245 + 12345) % 4294967296")
    # quantiles 0, 1/4, 1/2, 3/4, 1 of the numeric column; the distinct inner ones cut it
    strata = """fx_qs AS (SELECT list_distinct(quantile_disc(user_buy_product_times, [0, 0.25, 0.5, 0.75, 1.0])) AS qs FROM fx_ft),
fx_st AS (SELECT *, len(list_filter(qs, lambda q: q > list_min(qs) AND q < list_max(qs) AND q < user_buy_product_times)) AS s
          FROM fx_ft, fx_qs),"""
    for name, source, by in (("classes", "fx_ft", "reordered"), ("numeric", "fx_st", "s")):
        q[f"split_exact_{name}"] = ft(T, feat_ctes + "," + (strata if name == "numeric" else "") + f"""
fx_ranked AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {hashed}, user_id, order_number, product_id,
                     add_to_cart_order) AS rn, count(*) OVER (PARTITION BY {by}) AS n FROM {source})""", """
SELECT user_id, order_number, product_id, add_to_cart_order, reordered,
       CASE WHEN rn <= ceil(n * 80 / 100.0) THEN 'train' ELSE 'holdout' END AS part FROM fx_ranked""")
    # the same results by another route
    q["store_feature_table"], q["store_user_unique_products"] = q["feature_table"], q["user_unique_products"]
    q["distinct_purchases"] = ft(A, "", "SELECT DISTINCT order_id, product_id, reordered FROM fx_lines")
    return q
