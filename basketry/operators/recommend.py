"""Per-user product lists: predicted, actually reordered, side by side, id list.

Lists keep duplicates and follow product id order. Lines are first reduced to
(user, product, copies) by a partial aggregate, so the per-user list step sees
at most one entry per distinct product of the user, not one per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.config import ID_SEPARATOR, LABEL_COL, NAME_SEPARATOR
from basketry.functions.joins import bounded_broadcast
from basketry.operators.evaluate import PRED_COL

# List column names "produtos_previstos", "produtos_reais" and "produtos", as upstream.


def _ordered_list(rows: DataFrame, text_col: str, sep: str, out_col: str) -> DataFrame:
    """``user_id, out_col``: ``text_col`` repeated ``copies`` times, joined by ``sep`` in product id order."""
    piece = F.array_join(F.array_repeat(F.col(text_col), F.col("copies").cast("int")), sep)
    return rows.select("user_id", "product_id", piece.alias("__piece")).groupBy("user_id").agg(
        F.expr(f"listagg(__piece, '{sep}') WITHIN GROUP (ORDER BY product_id)").alias(out_col))


def _product_copies(df: DataFrame) -> DataFrame:
    return df.groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("copies"))


def _named_list(df: DataFrame, products: DataFrame, out_col: str) -> DataFrame:
    copies = _product_copies(df)
    # a product without a name is printed as "NA"
    names = bounded_broadcast(products.select("product_id", F.coalesce("product_name", F.lit("NA")).alias("product_name")))
    return _ordered_list(copies.join(names, "product_id", "inner"), "product_name", NAME_SEPARATOR, out_col)


def predicted_products(scored: DataFrame, products: DataFrame, pred: str = PRED_COL) -> DataFrame:
    """M9: ``user_id, produtos_previstos`` from rows predicted 1."""
    return _named_list(scored.filter(F.col(pred) == 1), products, "produtos_previstos")


def actual_products(scored: DataFrame, products: DataFrame, label: str = LABEL_COL) -> DataFrame:
    """``user_id, produtos_reais`` from rows actually reordered."""
    return _named_list(scored.filter(F.col(label) == 1), products, "produtos_reais")


def predicted_vs_actual(scored: DataFrame, products: DataFrame, pred: str = PRED_COL,
                        label: str = LABEL_COL) -> DataFrame:
    """Users having both lists (inner join on user)."""
    return predicted_products(scored, products, pred).join(actual_products(scored, products, label),
                                                           "user_id", "inner")


def submission_list(scored: DataFrame, pred: str = PRED_COL) -> DataFrame:
    """``user_id, produtos`` = predicted product ids separated by a space."""
    copies = _product_copies(scored.filter(F.col(pred) == 1)) \
        .withColumn("__id", F.col("product_id").cast("string"))
    return _ordered_list(copies, "__id", ID_SEPARATOR, "produtos")
