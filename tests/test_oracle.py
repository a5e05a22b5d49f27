"""Registered queries against their DuckDB oracle on the smallest fixture."""

import pytest

import __spark_entry__ as E
from basketry.plans.oracle import oracle_statements
from harness import compare

KEYS = sorted(oracle_statements())


def test_contract_keys_match():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["lhs", "rhs", "support", "confidence", "lift", "coverage", "count"]
    assert len(rows) == 5 and all(r["lift"] > 1 for r in rows)
    # the strongest rule has three items on the left: pairs alone would miss it
    assert rows[0]["lhs"] == "{Brand#10 MEDIUM,Brand#14 ECONOMY,Brand#7 SMALL}" and rows[0]["rhs"] == "{Brand#4 SMALL}"
    assert abs(rows[0]["lift"] - 63.9) < 0.1


def test_rules_of_all_sizes_feed_every_rule_query(spark, sf_small):
    q = E.queries()
    assert q["association_rules"](spark, sf_small).count() == q["rule_matrix"](spark, sf_small).count() == 5711
    assert q["rule_scatter"](spark, sf_small).count() == 5711
    assert q["pair_rules"](spark, sf_small).count() == 3040
    assert q["rules_lift_gt1"](spark, sf_small).count() == 5307
    grouped = q["rule_groups"](spark, sf_small)
    assert grouped.agg({"n_rules": "sum"}).first()[0] == 5711


def test_whole_history_has_spread_and_repeats(spark, sf_small):
    q = E.queries()
    users = q["user_features_all"](spark, sf_small)
    assert users.where("std_dow > 0 and std_doh > 0 and std_since_order > 0").count() > 100
    assert users.where("total_orders_by_user > 2").count() > 100
    assert q["user_buy_product_times_all"](spark, sf_small).where("user_buy_product_times > 2").count() > 100


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, key):
    ok, msg = compare(E.queries()[key](spark, sf_small), E.oracle_sql()[key], sf_small)
    assert ok, msg
