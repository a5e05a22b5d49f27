"""Data behind the four rule charts (scatter, graph, matrix, grouped).

Only the datasets are built; drawing is left to any plotting tool. Rules are
identified by their text label ``{lhs} => {rhs}``, which is unique and needs
no global numbering.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.encode import level_codes
from basketry.operators.rules import rule_labels
from basketry.session import materialize

GROUPS = 20
ROUNDS = 50          # rounds of the grouping at most
LIFT_SCALE = 1000    # lifts are grouped in steps of 1 / 1000


def rule_scatter(rules: DataFrame) -> DataFrame:
    """Support (x), lift (y), confidence (shade) per rule."""
    return rule_labels(rules).select("lhs", "rhs", "support", "lift", "confidence")


def rule_graph_edges(rules: DataFrame) -> DataFrame:
    """Item -> rule edges for antecedent items, rule -> item edges for the consequent."""
    rid = F.concat_ws(" => ", "lhs", "rhs")
    with_items = rules.select(F.concat(F.lit("{"), F.array_join("antecedent", ","), F.lit("}")).alias("lhs"),
                              F.concat(F.lit("{"), F.array_join("consequent", ","), F.lit("}")).alias("rhs"),
                              "antecedent", "consequent", "support", "lift")
    ins = with_items.select(rid.alias("rule"), F.explode("antecedent").alias("item"),
                            F.lit("item_to_rule").alias("direction"), "support", "lift")
    outs = with_items.select(rid.alias("rule"), F.explode("consequent").alias("item"),
                             F.lit("rule_to_item").alias("direction"), "support", "lift")
    return ins.unionByName(outs)


def rule_matrix(rules: DataFrame) -> DataFrame:
    """Long form of the antecedent x consequent lift matrix."""
    return rule_labels(rules).select("lhs", "rhs", "lift")


def lift_profiles(lab: DataFrame, scale: int = LIFT_SCALE) -> DataFrame:
    """``lhs, v``: each antecedent's lifts over all consequents in label order, in whole ``1 / scale`` (1 where no rule is)."""
    codes, n_rhs = level_codes(lab, "rhs")
    keyed = lab.join(codes.select(F.col("__level").alias("rhs"), F.col("__code").alias("j")), "rhs")
    held = keyed.groupBy("lhs").agg(F.map_from_entries(F.collect_list(
        F.struct(F.col("j").cast("long"), F.round(F.col("lift") * scale).cast("long")))).alias("m"))
    return held.select("lhs", F.transform(F.sequence(F.lit(1).cast("long"), F.lit(n_rhs).cast("long")),
                                          lambda j: F.coalesce(F.element_at("m", j), F.lit(scale).cast("long"))).alias("v"))


def _distance(centre: list[int]):
    """Squared distance of a row's profile; summed in the order of the array, so it is the same in any task."""
    to = F.lit(np.array(centre, np.int64))
    squares = F.zip_with("v", to, lambda a, b: (a - b).cast("double") * (a - b).cast("double"))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)


def _farthest_first(profiles: DataFrame, k: int, seed: int) -> list[list[int]]:
    """At most ``k`` first centres: one by the seed's hash, then always the profile farthest from those so far."""
    centres = [list(r.v) for r in profiles.orderBy(F.xxhash64("lhs", F.lit(seed)), "lhs").limit(1).collect()]
    while centres and len(centres) < k:
        reach = F.array_min(F.array(*[_distance(c) for c in centres]))
        far = profiles.select("lhs", "v", reach.alias("reach")).where("reach > 0").orderBy(
            F.desc("reach"), "lhs").limit(1).collect()
        if not far:
            break
        centres.append(list(far[0].v))
    return centres


def _grouped(profiles: DataFrame, centres: list[list[int]]) -> DataFrame:
    """Each profile with its nearest centre, the first of equally near ones."""
    reach = F.array(*[_distance(c) for c in centres])
    return profiles.withColumn("reach", reach).select(
        "lhs", "v", (F.array_position("reach", F.array_min("reach")) - 1).cast("int").alias("grp"))


def profile_groups(profiles: DataFrame, k: int = GROUPS, seed: int = 42, rounds: int = ROUNDS) -> DataFrame:
    """``lhs, grp``: k-means of whole-number profiles (lhs, v), the same for any partitioning.

    Centres are whole numbers too (sums divided, rounding down), so no sum depends on
    the order of rows. Ties: the farthest profile with the least ``lhs``, the first of
    equally near centres; a centre that loses all profiles stays. It ends when no
    centre moves, at the latest after ``rounds`` rounds. A round is one partial
    aggregate; the driver sees k centres of as many numbers as there are consequents.
    """
    centres = _farthest_first(profiles, k, seed)
    if not centres:
        return profiles.select("lhs", F.lit(0).alias("grp"))
    for _ in range(rounds):
        sums = _grouped(profiles, centres).select("grp", F.posexplode("v")).groupBy("grp", "pos").agg(
            F.sum("col").alias("total"), F.count("*").alias("n")).collect()
        moved = [list(c) for c in centres]
        for r in sums:
            moved[r.grp][r.pos] = r.total // r.n
        if moved == centres:
            break
        centres = moved
    return _grouped(profiles, centres).select("lhs", "grp")


def rule_groups(rules: DataFrame, k: int = GROUPS, seed: int = 42) -> DataFrame:
    """Antecedents clustered on their lift profile over consequents.

    Each antecedent gets a vector of lifts over the consequent items (1 where
    no rule exists), k-means puts antecedents into at most ``k`` groups, and
    each (group, consequent) reports rule count, median lift and median support.
    No rules give an empty result.
    """
    lab = rule_labels(rules)
    g = lab.join(profile_groups(materialize(lift_profiles(lab), "lift_profiles"), k, seed), "lhs")
    return g.groupBy("grp", "rhs").agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.median("lift").alias("median_lift"),
        F.median("support").alias("median_support"),
        F.count_distinct("lhs").alias("antecedents"))
