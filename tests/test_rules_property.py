"""Pair rules equal a brute-force count on random baskets."""

import math
from itertools import permutations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketry.operators import rules as ru

ITEMS = ["a", "b", "c", "d", "e", "f"]
baskets_st = st.lists(st.sets(st.sampled_from(ITEMS), min_size=1, max_size=5), min_size=1, max_size=40)


def brute(baskets, min_support, min_conf):
    n = len(baskets)
    need = math.ceil(min_support * n)
    cnt = {i: sum(i in b for b in baskets) for i in ITEMS}
    out = {}
    for x, y in permutations(ITEMS, 2):
        c = sum(x in b and y in b for b in baskets)
        if c and c >= need and cnt[x] >= need and c / cnt[x] >= min_conf:
            out[(x, y)] = (c, c / n, c / cnt[x], c * n / (cnt[x] * cnt[y]))
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(baskets=baskets_st, support=st.sampled_from([0.01, 0.1, 0.25]), conf=st.sampled_from([0.0, 0.3, 0.6]))
def test_pair_rules_equal_brute_force(spark, baskets, support, conf):
    df = spark.createDataFrame([(i, sorted(b)) for i, b in enumerate(baskets)], "order_id long, items array<string>")
    got = {(r["antecedent"][0], r["consequent"][0]): (r["count"], r["support"], r["confidence"], r["lift"])
           for r in ru.pair_rules(df, support, conf).collect()}
    want = brute(baskets, support, conf)
    assert set(got) == set(want)
    for k, (c, s, cf, lift) in want.items():
        assert got[k][0] == c
        assert abs(got[k][1] - s) < 1e-12 and abs(got[k][2] - cf) < 1e-12 and abs(got[k][3] - lift) < 1e-9


def test_more_than_4096_items_and_one_basket_of_100(spark):
    data = [(i, [f"i{2 * i}", f"i{2 * i + 1}"]) for i in range(2500)]
    data.append((9999, sorted({f"i{k * 49}" for k in range(100)})))
    df = spark.createDataFrame(data, "order_id long, items array<string>")
    rules = ru.pair_rules(df, 0.0, 0.0)
    got = {(r["antecedent"][0], r["consequent"][0]): r["count"] for r in rules.collect()}
    want = {}
    for _, items in data:
        for x, y in permutations(items, 2):
            want[x, y] = want.get((x, y), 0) + 1
    assert got == want and len({x for x, _ in got}) > 4096
