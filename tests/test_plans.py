"""Physical-plan properties the scale design relies on."""

import __spark_entry__ as E


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_products_is_take_ordered_not_sort(spark, sf_small):
    p = plan(E.queries()["top_products"](spark, sf_small))
    assert "TakeOrderedAndProject" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scope_filter_pushed_to_scan(spark, sf_small):
    p = plan(E.queries()["order_line_base"](spark, sf_small))
    assert "PushedFilters: [IsNotNull(eval_set), EqualTo(eval_set,train)" in p


def test_frequent_lines_use_broadcast_semi_join(spark, sf_small):
    p = plan(E.queries()["freq_order_lines"](spark, sf_small))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_pair_rules_count_pairs_partially(spark, sf_small):
    p = plan(E.queries()["pair_rules"](spark, sf_small))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "partial_count(1)" in p


def test_user_features_need_no_expansion(spark, sf_small):
    for key in ("user_features", "product_features", "user_features_all"):
        assert "Expand" not in plan(E.queries()[key](spark, sf_small))


def test_product_lines_stay_on_the_streamed_side(spark, sf_small):
    for key in ("product_lines_fanout", "product_base_suffix_join"):
        p = plan(E.queries()[key](spark, sf_small))
        assert "BuildRight" in p and "SortMergeJoin" not in p and "RightOuter" not in p


def test_feature_table_reads_materialized_base(spark, sf_small):
    p = plan(E.queries()["user_features"](spark, sf_small))
    # one scan of the written line table, pruned to the user measures' inputs; no joins or windows re-run
    assert "Window" not in p and "Join" not in p
    assert "ReadSchema: struct<user_id:bigint,order_number:int,order_dow:int" in p


def test_top_products_never_shuffles_the_catalog(spark):
    from basketry.operators import baskets as bk
    lines = spark.range(0, 2000).selectExpr("id AS order_id", "id % 50 AS product_id")
    catalog = spark.range(0, 50).selectExpr("id AS product_id", "concat('p', id) AS product_name",
                                            "1 AS aisle_id", "1 AS department_id")
    p = plan(bk.top_products(lines, catalog, 10))
    assert "SortMergeJoin" not in p and "LeftSemi" in p and "TakeOrderedAndProject" in p


def test_occurrence_number_is_one_window_for_ordinary_users(spark, sf_small):
    from basketry.operators import features as fe
    from basketry.plans.registry import _ctx
    from basketry.session import materialize
    lines = materialize(fe.order_line_base(_ctx(spark, sf_small).tables, "all"), "joined_lines")
    p = plan(fe.with_occurrence_number(lines))
    assert "Join" not in p and p.count("Exchange hashpartitioning") == 1


def test_sketched_counts_shuffle_sketches_only(spark, sf_small):
    from basketry.operators import sketches as sk
    from basketry.plans.registry import _ctx
    base = _ctx(spark, sf_small).base("all")
    p = plan(sk.merged_counts(sk.sketch_states(base, "aisle_id", "user_id", "order_dow"), "aisle_id", "n"))
    assert "partial_hll" in p and "hashpartitioning(aisle_id" in p
    assert "user_id" not in "".join(line for line in p.splitlines() if "Exchange" in line)
