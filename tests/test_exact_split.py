import math

import pytest
from pyspark.sql import functions as F

from basketry.operators import split as sp

SCHEMA = "user_id long, order_number int, product_id long, add_to_cart_order int, reordered double"


def table(spark, labels=(0.0, 1.0, 1.0, 1.0, None)):
    data = [(u, o, p, 1, labels[(u * 7 + p * o) % len(labels)]) for u in range(1, 40) for o in range(1, 5) for p in (3, 8, 11)]
    return spark.createDataFrame(data, SCHEMA)


def hash_of(r):
    key = r.user_id * 7919 + r.order_number * 104729 + r.product_id * 31 + r.add_to_cart_order * 17
    return (key % 2147483647 * 1103515245 + 12345) % 4294967296


@pytest.mark.parametrize("bits", [32, 17, 3, 0])
def test_the_smallest_hashes_of_each_class_are_training_rows(spark, monkeypatch, bits):
    """With few bits of the hash left many rows tie at the limit and go by their key."""
    if bits < 32:
        whole = sp.split_hash()
        monkeypatch.setattr(sp, "split_hash", lambda: F.pmod(whole, F.lit(1 << bits)))
    got = sp.exact_sides(table(spark), F.col("reordered"), 80).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.reordered, []).append(r)
    assert set(groups) == {0.0, 1.0, None} and len(got) == 39 * 4 * 3
    for rows in groups.values():
        rows.sort(key=lambda r: (hash_of(r) % (1 << bits), r.user_id, r.order_number, r.product_id, r.add_to_cart_order))
        k = math.ceil(len(rows) * 0.8)
        assert [r.part for r in rows] == ["train"] * k + ["holdout"] * (len(rows) - k)


def test_numeric_strata_lie_between_quantiles(spark):
    df = table(spark, tuple(float(i) for i in range(20)))
    sided = sp.exact_sides(df.withColumn("s", sp.numeric_strata(df, "reordered")), F.col("s"))
    counts = {(r.s, r.part): r["count"] for r in sided.groupBy("s", "part").count().collect()}
    assert {s for s, _ in counts} == {0, 1, 2, 3}
    for s in range(4):
        n = counts[s, "train"] + counts[s, "holdout"]
        assert counts[s, "train"] == math.ceil(n * 0.8)
    binary = table(spark, (0.0, 1.0))
    assert sp.exact_sides(binary, sp.numeric_strata(binary, "reordered")).where("part = 'train'").count() == math.ceil(468 * 0.8)


def test_no_rows_and_no_window_over_rows(spark):
    df = table(spark)
    assert sp.exact_sides(df.limit(0), F.col("reordered")).count() == 0
    plan = sp.exact_sides(df, F.col("reordered"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
