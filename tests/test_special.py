import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from basketry.functions import special as sp
from basketry.operators import evaluate as ev


def tail(k, n, p):
    """P(X >= k) in whole numbers, for p as the fraction that the double is."""
    yes, both = Fraction(p).as_integer_ratio()
    no, total, term = both - yes, 0, math.comb(n, k) * yes**k * (both - yes)**(n - k)
    if not no:
        return 1.0
    for i in range(k, n + 1):
        total += term
        term = term * (n - i) * yes // ((i + 1) * no)
    return float(Fraction(total, both**n))


def test_upper_tail_of_every_small_count(spark):
    rows = [(float(k), float(n), p) for n in (1, 2, 7, 16, 40) for k in range(n + 1) for p in (0.03125, 0.375, 0.5, 0.96875)]
    df = spark.createDataFrame(rows, "k double, n double, p double")
    for r in df.withColumn("t", sp.binomial_upper_tail(F.col("k"), F.col("n"), F.col("p"))).collect():
        want = tail(int(r.k), int(r.n), r.p)
        assert abs(r.t - want) < 1e-9 * max(want, 1e-3), r


def test_upper_tail_of_large_counts(spark):
    rows = [(float(k), float(n), p) for n, p in ((3000, 0.75), (11791, 0.5)) for k in (int(n * p) - 90, int(n * p), int(n * p) + 120)]
    df = spark.createDataFrame(rows, "k double, n double, p double")
    for r in df.withColumn("t", sp.binomial_upper_tail(F.col("k"), F.col("n"), F.col("p"))).collect():
        assert abs(r.t - tail(int(r.k), int(r.n), r.p)) < 1e-9, r


def test_interval_inverts_the_tails_and_ends_at_its_edges(spark):
    rows = [(float(k), float(n)) for n in (1, 5, 30, 400) for k in {0, 1, n // 2, n - 1, n}]
    df = spark.createDataFrame(rows + [(0.0, 0.0)], "k double, n double")
    low, high = sp.binomial_interval(F.col("k"), F.col("n"))
    for r in df.select("k", "n", low.alias("low"), high.alias("high")).collect():
        k, n = int(r.k), int(r.n)
        if not n:
            assert r.low is None and r.high is None
            continue
        assert (r.low == 0.0) if k == 0 else abs(tail(k, n, r.low) - 0.025) < 1e-9
        assert (r.high == 1.0) if k == n else abs(1 - tail(k + 1, n, r.high) - 0.025) < 1e-9


def test_chi_square_tail(spark):
    xs = [0.0, 1e-6, 0.1, 1.0, 3.841458820694124, 5.9, 6.1, 20.0, 200.0, 1000.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double").withColumn("p", sp.chi_square_1_tail(F.col("x")))
    for x, p in df.collect():
        assert abs(p - math.erfc(math.sqrt(x / 2))) < 1e-12 + 1e-9 * p


@pytest.mark.parametrize("cells", [(40, 10, 4, 20), (0, 0, 0, 0), (9, 0, 0, 0), (0, 5, 6, 0)])
def test_summary_row(spark, cells):
    keys = [(0, 0), (0, 1), (1, 0), (1, 1)]
    counts = spark.createDataFrame([(*k, n) for k, n in zip(keys, cells, strict=True)], "prediction int, reference int, n long")
    r = ev.confusion_tests(counts).first()
    n, right = sum(cells), cells[0] + cells[3]
    assert (r["n"], r["n_right"]) == (n, right if n else None)
    if not n:
        assert r["accuracy_lower"] is None and r["accuracy_p_value"] is None and r["mcnemar_p_value"] is None
        return
    assert abs(r["accuracy_p_value"] - tail(right, n, r["no_information_rate"])) < 1e-9
    assert r["accuracy_lower"] <= r["accuracy"] <= r["accuracy_upper"]
    if cells[1] + cells[2] == 0:
        assert r["mcnemar_p_value"] is None
    else:
        assert abs(r["mcnemar_p_value"] - math.erfc(math.sqrt(r["mcnemar_statistic"] / 2))) < 1e-9
