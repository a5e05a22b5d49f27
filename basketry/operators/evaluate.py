"""Thresholding, outcome shares and the 2x2 confusion matrix with its measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.config import LABEL_COL, LABEL_RIGHT, LABEL_WRONG
from basketry.functions.special import binomial_interval, binomial_upper_tail, chi_square_1_tail

PRED_COL = "prediction"
# Outcome column names "sucesso" and "contagem" (labels "sim" / "não" in config).


def threshold(df: DataFrame, score_col: str, t: float, out_col: str = PRED_COL) -> DataFrame:
    """1 when score >= t (inclusive), else 0."""
    return df.withColumn(out_col, F.when(F.col(score_col) >= F.lit(t), F.lit(1)).otherwise(F.lit(0)))


def percent_text(c) -> F.Column:
    """77.0 -> "77 %", 77.1 -> "77.1 %", 77.12 -> "77.12 %" (two decimals at most, no trailing zeros)."""
    return F.concat(F.regexp_replace(F.format_string("%.2f", c), r"\.?0+$", ""), F.lit(" %"))


def outcome_share(df: DataFrame, label: str = LABEL_COL, pred: str = PRED_COL) -> DataFrame:
    """P12 + G7 + W2 + M7: right / wrong counts and their share in percent.

    ``sucesso`` is "sim" when the prediction equals the label, else "não";
    ``acertos_pct`` is the share rounded half-to-even to 2 places and
    ``acertos_texto`` its text with a percent sign. The window over the whole
    result is safe: it sees two rows.
    """
    ok = F.when(F.col(label) == F.col(pred), F.lit(LABEL_RIGHT)).otherwise(F.lit(LABEL_WRONG))
    counts = df.groupBy(ok.alias("sucesso")).agg(F.count(F.lit(1)).alias("contagem"))
    share = F.bround(F.try_divide(F.col("contagem") * 100, F.sum("contagem").over(Window.partitionBy())), 2)
    return counts.select("sucesso", "contagem", share.alias("acertos_pct")) \
        .withColumn("acertos_texto", percent_text(F.col("acertos_pct")))


def confusion_counts(df: DataFrame, label: str = LABEL_COL, pred: str = PRED_COL) -> DataFrame:
    """All four (prediction, reference) cells, zeros included, in one pass."""
    cells = df.agg(
        F.count_if((F.col(pred) == 0) & (F.col(label) == 0)).alias("c00"),
        F.count_if((F.col(pred) == 0) & (F.col(label) == 1)).alias("c01"),
        F.count_if((F.col(pred) == 1) & (F.col(label) == 0)).alias("c10"),
        F.count_if((F.col(pred) == 1) & (F.col(label) == 1)).alias("c11"))
    return cells.selectExpr("stack(4, 0, 0, c00, 0, 1, c01, 1, 0, c10, 1, 1, c11) as (prediction, reference, n)") \
        .select(F.col("prediction").cast("int"), F.col("reference").cast("int"), F.col("n").cast("long"))


def confusion_metrics(counts: DataFrame, positive: int = 0) -> DataFrame:
    """Accuracy, kappa and the other 2x2 measures, ``positive`` class first.

    Cells with the positive class p: a = pred p & ref p, b = pred p & ref not p,
    c = pred not p & ref p, d = pred not p & ref not p. Undefined ratios are NULL.
    """
    neg = 1 - positive
    cell = lambda p, r: F.sum(F.when((F.col("prediction") == p) & (F.col("reference") == r), F.col("n"))
                              .otherwise(0)).cast("double")
    m = counts.agg(cell(positive, positive).alias("a"), cell(positive, neg).alias("b"),
                   cell(neg, positive).alias("c"), cell(neg, neg).alias("d"))
    a, b, c, d = (F.col(x) for x in "abcd")
    n = a + b + c + d
    div = F.try_divide
    acc = div(a + d, n)
    pe = div((a + b) * (a + c) + (c + d) * (b + d), n * n)
    sens = div(a, a + c)
    spec = div(d, b + d)
    return m.select(
        F.lit(positive).alias("positive"), n.cast("long").alias("n"),
        acc.alias("accuracy"),
        div(F.greatest(a + c, b + d), n).alias("no_information_rate"),
        div(acc - pe, 1 - pe).alias("kappa"),
        sens.alias("sensitivity"), spec.alias("specificity"),
        div(a, a + b).alias("pos_pred_value"), div(d, c + d).alias("neg_pred_value"),
        div(a + c, n).alias("prevalence"), div(a, n).alias("detection_rate"),
        div(a + b, n).alias("detection_prevalence"),
        ((sens + spec) / 2).alias("balanced_accuracy"),
        # the continuity correction applies only if the two cells differ
        div(F.when(b == c, F.lit(0.0)).otherwise((F.abs(b - c) - 1) * (F.abs(b - c) - 1)), b + c)
        .alias("mcnemar_statistic"))


def confusion_tests(counts: DataFrame, level: float = 0.95) -> DataFrame:
    """Exact interval of the accuracy, its test against the no-information rate, and McNemar's p-value.

    One row; NULL where a test is not defined (no rows, or no wrong predictions for
    McNemar's). The interval inverts the binomial distribution, the first p-value is
    the chance of at least as many right answers at the no-information rate.
    """
    m = confusion_metrics(counts, positive=0).select(
        F.col("n").cast("double").alias("n"), F.round(F.col("accuracy") * F.col("n")).alias("right"), "accuracy",
        "no_information_rate", "mcnemar_statistic")
    low, high = binomial_interval(F.col("right"), F.col("n"), level)
    return m.select(
        F.col("n").cast("long").alias("n"), F.col("right").cast("long").alias("n_right"), "accuracy",
        low.alias("accuracy_lower"), high.alias("accuracy_upper"), "no_information_rate",
        binomial_upper_tail(F.col("right"), F.col("n"), F.col("no_information_rate")).alias("accuracy_p_value"),
        "mcnemar_statistic", chi_square_1_tail(F.col("mcnemar_statistic")).alias("mcnemar_p_value"))
