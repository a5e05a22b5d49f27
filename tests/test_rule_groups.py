"""Grouped rule chart: the grouping against a plain version, any partitioning."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from basketry.operators import rule_charts as ch


def plain_groups(profiles, first, k, rounds=50):
    """{lhs: group} of {lhs: vector}, from the label of the first centre."""
    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    centres = [profiles[first]]
    while len(centres) < k:
        reach, lhs = min((-min(far(v, c) for c in centres), lhs) for lhs, v in profiles.items())
        if reach == 0:
            break
        centres.append(profiles[lhs])

    def nearest():
        return {lhs: min(range(len(centres)), key=lambda g: (far(v, centres[g]), g)) for lhs, v in profiles.items()}

    for _ in range(rounds):
        groups, moved = nearest(), list(centres)
        for g in set(groups.values()):
            of = [profiles[lhs] for lhs in groups if groups[lhs] == g]
            moved[g] = [sum(x) // len(of) for x in zip(*of)]
        if moved == centres:
            break
        centres = moved
    return nearest()


def first_label(df, seed):
    return df.orderBy(F.xxhash64("lhs", F.lit(seed)), "lhs").first().lhs


@pytest.mark.parametrize("n, k, parts", [(40, 5, 1), (40, 5, 7), (12, 20, 3), (1, 4, 1)])
def test_profiles_meet_their_nearest_centre(spark, n, k, parts):
    rng = random.Random(n)
    # few values and repeated profiles: many ties
    profiles = {f"{{i{x:02d}}}": [1000 * rng.randrange(1, 4) for _ in range(4)] for x in range(n)}
    df = spark.createDataFrame(list(profiles.items()), "lhs string, v array<long>").repartition(parts)
    got = {r.lhs: r.grp for r in ch.profile_groups(df, k, seed=7).collect()}
    assert got == plain_groups(profiles, first_label(df, 7), k)


def test_group_measures(spark):
    rng = random.Random(5)
    rules = [([f"a{x}"], [f"c{y}"], rng.random(), rng.random(), round(rng.uniform(0.5, 9), 4), rng.random(), 3)
             for x in range(15) for y in range(6) if rng.random() < 0.6]
    df = spark.createDataFrame(rules, "antecedent array<string>, consequent array<string>, support double, "
                                      "confidence double, lift double, coverage double, count long")
    rhs = sorted({f"{{{r[1][0]}}}" for r in rules})
    profiles = {}
    for r in rules:
        profiles.setdefault(f"{{{r[0][0]}}}", [1000] * len(rhs))[rhs.index(f"{{{r[1][0]}}}")] = round(r[4] * 1000)
    labels = spark.createDataFrame([(x,) for x in profiles], "lhs string")
    groups = plain_groups(profiles, first_label(labels, 42), 4)
    want = {}
    for r in rules:
        want.setdefault((groups[f"{{{r[0][0]}}}"], f"{{{r[1][0]}}}"), []).append((r[4], r[2], r[0][0]))
    got = {(r.grp, r.rhs): (r.n_rules, r.median_lift, r.median_support, r.antecedents)
           for r in ch.rule_groups(df, k=4).collect()}
    assert got == {key: (len(v), pytest.approx(median(x[0] for x in v)), pytest.approx(median(x[1] for x in v)),
                         len({x[2] for x in v})) for key, v in want.items()}
    assert ch.rule_groups(df.limit(0)).count() == 0
