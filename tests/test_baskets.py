from pyspark.sql import functions as F

from basketry.operators import baskets as bk
from basketry.operators import rules as ru
from tables_util import small_tables


def test_top_n_ties_resolved_by_product_id(spark):
    lines = spark.createDataFrame([(1, 5), (2, 5), (1, 3), (2, 3), (1, 4), (3, 7), (4, 7)],
                                  "order_id long, product_id long")
    prods = spark.createDataFrame([(p, f"p{p}", 1, 1) for p in (3, 4, 5, 7)],
                                  "product_id long, product_name string, aisle_id int, department_id int")
    top = [r["product_id"] for r in bk.top_products(lines, prods, 2).orderBy(F.desc("frequency"), "product_id")
           .collect()]
    assert top == [3, 5]


def test_baskets_merge_shared_names_and_repeats(spark):
    t = small_tables(spark)
    named = bk.lines_with_products(t.lines("all"), t.products)
    b = {r["order_id"]: r["items"] for r in bk.baskets(named).collect()}
    # order 3 holds product 10 twice and product 13, which shares the name "apple"
    assert b[3] == ["apple"]
    assert b[1] == ["apple", "pear"]


def test_incidence_fills_missing_cells_false(spark):
    t = small_tables(spark)
    named = bk.lines_with_products(t.lines("all"), t.products)
    inc = {r["order_id"]: r.asDict() for r in bk.basket_incidence(named, ["apple", "milk", "pear"]).collect()}
    assert inc[4] == {"order_id": 4, "apple": False, "milk": True, "pear": False}


def _rules_fixture(spark):
    data = [(1, ["a", "b", "c"]), (2, ["a", "b"]), (3, ["a", "c"]), (4, ["b", "c"]), (5, ["a", "b", "c"]),
            (6, ["d"]), (7, ["a", "d"]), (8, ["b"])]
    return spark.createDataFrame(data, "order_id long, items array<string>")


def test_pair_rules_match_fpgrowth_single_antecedent(spark):
    b = _rules_fixture(spark)
    pr = {(r["antecedent"][0], r["consequent"][0]): r for r in ru.pair_rules(b, 0.2, 0.3).collect()}
    fp = {(r["antecedent"][0], r["consequent"][0]): r
          for r in ru.fpgrowth_rules(b, 0.2, 0.3).filter(F.size("antecedent") == 1).collect()}
    assert set(pr) == set(fp) and pr
    for k in pr:
        for m in ("support", "confidence", "lift", "coverage"):
            assert abs(pr[k][m] - fp[k][m]) < 1e-12, (k, m)
        assert pr[k]["count"] == fp[k]["count"]


def test_rule_measure_properties(spark):
    b = _rules_fixture(spark)
    got = {(r["antecedent"][0], r["consequent"][0]): r for r in ru.pair_rules(b, 0.1, 0.0).collect()}
    for (x, y), r in got.items():
        assert abs(r["confidence"] - r["support"] / r["coverage"]) < 1e-12
        assert got[(y, x)]["lift"] == r["lift"]
    assert got[("a", "b")]["count"] == 3 and got[("a", "b")]["support"] == 3 / 8


def test_top_rules_filter_and_order(spark):
    b = _rules_fixture(spark)
    top = ru.top_rules(ru.pair_rules(b, 0.1, 0.0), 3).collect()
    lifts = [r["lift"] for r in top]
    assert all(x > 1 for x in lifts) and lifts == sorted(lifts, reverse=True)


def test_rule_counts_match_fixture_figures(spark, sf_small):
    """FIXTURES.md section 5: mapping A names, whole history, support 0.001, confidence 0.2 at sf0.001
    gives 8 / 2,318 / 184 / 0 rules by antecedent size 1 / 2 / 3 / 4, and 2,510 with lift > 1."""
    from basketry.config import RuleParams
    from basketry.plans import analyses
    from basketry.sources.fixtures import tpch_tables

    t = tpch_tables(spark, sf_small, materialize_tables=True)
    res = analyses.basket_rules(t, "all", RuleParams(min_confidence=0.2))
    by_size = {r["k"]: r["n"] for r in res.rules.groupBy(F.size("antecedent").alias("k")).count()
               .withColumnRenamed("count", "n").collect()}
    assert by_size == {1: 8, 2: 2318, 3: 184}
    assert ru.filter_lift(res.rules).count() == 2510
    pairs = analyses.basket_rules(t, "all", RuleParams(min_confidence=0.2), miner="pairs").rules
    assert pairs.count() == 8
