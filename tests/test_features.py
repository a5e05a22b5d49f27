from pyspark.sql import functions as F

from basketry.operators import features as fe
from tables_util import small_tables


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_occurrence_number_counts_repeats_in_one_order(spark):
    t = small_tables(spark)
    base = fe.enriched_line_base(t, "all")
    got = rows(base.filter("user_id = 1 AND product_id = 10"), "order_number", "add_to_cart_order",
               "user_buy_product_times")
    assert got == [(1, 1, 1), (2, 1, 2), (3, 1, 3), (3, 2, 4)]


def test_unique_product_count_joined_to_every_line(spark):
    t = small_tables(spark)
    base = fe.enriched_line_base(t, "all")
    assert rows(base.select("user_id", "unique_product_count").distinct(), "user_id", "unique_product_count") == \
        [(1, 5), (2, 1)]


def test_null_dimension_keys_form_one_group(spark):
    t = small_tables(spark)
    base = fe.enriched_line_base(t, "train")
    af = {r["aisle_id"]: r for r in fe.aisle_features(base).collect()}
    assert None in af and af[None]["aisle_total_orders"] == 1
    attrs = {r["product_id"]: r for r in fe.product_attributes(base, t).collect()}
    # product 99 is unknown: its aisle measures come from the NULL aisle group (NULL matches NULL)
    assert attrs[99]["aisle_total_orders"] == 1 and attrs[99]["aisle"] is None


def test_user_features_one_line_user_sd_filled(spark):
    t = small_tables(spark)
    base = fe.enriched_line_base(t, "train")
    raw = {r["user_id"]: r for r in fe.user_features(base).collect()}
    assert raw[2]["std_dow"] is None
    filled = {r["user_id"]: r for r in fe.user_features_filled(base).collect()}
    assert filled[2]["std_dow"] == 0.0 and filled[2]["total_products_by_user"] == 1
    assert filled[1]["total_orders_by_user"] == 1 and filled[1]["total_products_by_user"] == 4
    assert filled[1]["total_reorders_by_user"] == 2


def test_first_order_gap_filled_with_zero(spark):
    t = small_tables(spark)
    got = rows(fe.fill_days_since_prior(t.orders), "order_id", "days_since_prior_order")
    assert got == [(1, 0.0), (2, 7.0), (3, 30.0), (4, 0.0)]


def test_feature_table_shape_and_order(spark):
    t = small_tables(spark)
    ft = fe.feature_table(t, "train")
    base = fe.enriched_line_base(t, "train")
    assert ft.columns[0] == "product_id" and ft.columns[-1] == "reordered"
    assert "order_id" not in ft.columns and "aisle_id" not in ft.columns and "department_id" in ft.columns
    # 3 aisles + NULL -> 2 bits; 2 departments + NULL -> 2 bits
    assert [c for c in ft.columns if "_bin_" in c] == ["aisle_bin_1", "aisle_bin_2", "department_bin_1",
                                                        "department_bin_2"]
    n = ft.count()
    assert n == base.count() == ft.distinct().count()
    assert ft.filter(F.col("std_dow").isNull()).count() == 0
    assert len(ft.columns) == 1 + 7 + 5 + 5 + 4 + 10 + 11 + 1


def test_leakage_free_measures_use_fitted_rows_only(spark):
    t = small_tables(spark)
    fit = F.col("order_number") < 3  # the latest order of user 1 is held out
    ft = fe.feature_table(t, "all", fit_on=fit)
    full = fe.feature_table(t, "all")
    assert ft.count() == full.count()
    r = {(x["order_number"], x["add_to_cart_order"]): x for x in ft.filter("user_id = 1").collect()}
    # user 1 fitted on orders 1-2 only: 4 lines, 1 reorder
    assert r[(3, 1)]["total_products_by_user"] == 4 and r[(3, 1)]["total_reorders_by_user"] == 1
    # product 13 only appears in the held-out order: no fitted product measures
    assert r[(3, 4)]["total_orders"] is None


def test_lines_meet_user_measures_before_they_are_wide(spark):
    """The feature table's shuffle of the lines by user comes before the product features are joined."""
    base = spark.createDataFrame([(1, 1, 1, 0, 2)], "user_id long, product_id long, order_id long, reordered int, n int")
    wide = spark.createDataFrame([(1, 2.0)], "product_id long, product_measure double")
    measures = fe.USER_MEASURES
    users = base.groupBy("user_id").agg(*[F.max("n").alias(m) for m in measures])
    base = base.withColumn(fe.OCCURRENCE, F.lit(1))
    tree = fe.assemble(base, F.broadcast(wide), users)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in tree if "Join" in line]
    assert "product_id" in joins[0] and "user_id" in joins[1]
