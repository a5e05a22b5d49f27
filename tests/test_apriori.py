import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.operators import apriori as ap
from basketry.operators import rules as ru


def some_baskets(seed=1, n=400, planted=()):
    rng = random.Random(seed)
    items = [f"i{k:02d}" for k in range(25)]
    out = [sorted(set(rng.choices(items, k=rng.randrange(1, 7), weights=range(25, 0, -1)))) for _ in range(n)]
    return out + [sorted({*planted, rng.choice(items)}) for _ in range(40 if planted else 0)]


def frame(spark, baskets):
    return spark.createDataFrame([(i, b) for i, b in enumerate(baskets)], "order_id long, items array<string>").repartition(3)


def brute(baskets, need):
    out, k = {}, 1
    while True:
        level = Counter(s for b in baskets for s in itertools.combinations(sorted({x for x in b if x is not None}), k))
        level = {s: n for s, n in level.items() if n >= need}
        if not level:
            return out
        out |= level
        k += 1


def found(df):
    return {tuple(r["set"]): r["n"] for r in df.collect()}


PLANTED = ("p1", "p2", "p3", "p4", "p5", "p6", "p7")


def test_sets_of_all_sizes_and_the_rules_of_the_other_miner(spark):
    baskets = some_baskets(planted=PLANTED) + [[], None, ["i01", "i01", None]]
    df = frame(spark, baskets)
    need = ru.min_count(0.02, len(baskets))
    want = brute([b or [] for b in baskets], need)
    sets = ap.frequent_sets(df, 0.02)
    assert found(sets) == want and want[PLANTED] == 40
    clean = frame(spark, [b for b in some_baskets(planted=PLANTED)])
    ours = {(tuple(r.antecedent), tuple(r.consequent)): r for r in ap.apriori_rules(clean, 0.02, 0.1).collect()}
    theirs = {(tuple(r.antecedent), tuple(r.consequent)): r for r in ru.fpgrowth_rules(clean, 0.02, 0.1).collect()}
    assert ours.keys() == theirs.keys() and len(ours) > 500
    for key, r in ours.items():
        for c in ("support", "confidence", "lift", "coverage", "count"):
            assert abs(r[c] - theirs[key][c]) < 1e-9


def test_ranges_and_candidates(spark, monkeypatch):
    baskets = some_baskets(4, 5000)
    df = frame(spark, baskets).coalesce(1)   # more than one range in a partition
    bitmaps = ap.item_bitmaps(df)
    assert bitmaps.select("range").distinct().count() == 2
    per_item = {tuple(r["set"]): r["n"] for r in ap._counts(bitmaps, 1).collect()}
    assert per_item == {s: n for s, n in brute(baskets, 1).items() if len(s) == 1}
    level = spark.createDataFrame([(["a", "b"],), (["a", "c"],), (["b", "c"],), (["b", "d"],), (["a", "d"],)], "set array<string>")
    got = {tuple(r["set"]) for r in ap.candidates(level, 2).collect()}
    assert got == {("a", "b", "c"), ("a", "b", "d")}   # a,c,d and b,c,d lack c,d


@pytest.mark.parametrize("rows", [[], [[]], [["x"]]])
def test_tiny_inputs(spark, rows):
    df = spark.createDataFrame([(b,) for b in rows], "items array<string>")
    assert found(ap.frequent_sets(df, 0.5)) == brute(rows, 1)
    assert ap.apriori_rules(df, 0.5, 0.1).count() == 0


def test_pairs_are_counted_without_a_basket_shuffle(spark, monkeypatch):
    df = frame(spark, some_baskets(2))
    frequent = ru.item_counts(df).where("n >= 5")
    few = ru.pair_counts(df, frequent)
    assert "basket" not in few._jdf.queryExecution().optimizedPlan().toString()
    kept = ru._frequent_only(df, frequent)
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    want = sorted(map(tuple, few.collect()))
    monkeypatch.setattr(ru, "NAMES_IN_PLAN", 2)
    assert sorted(map(tuple, ru.pair_counts(df, frequent).collect())) == want
    brute_pairs = Counter(p for b in some_baskets(2) for p in itertools.combinations(b, 2))
    assert {(x, y): c for x, _, y, _, c in want} == {p: c for p, c in brute_pairs.items()
                                                     if all(r in {t[0] for t in want} | {t[2] for t in want} for r in p)}
    assert few.where(F.col("x") >= F.col("y")).count() == 0
