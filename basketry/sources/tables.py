"""The five input tables and the line scope an analysis runs on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

SCOPES = ("train", "all")


@dataclass
class Tables:
    """orders, products, aisles, departments and the two order-line files.

    ``scope="train"`` is the most recent order of every user (the file the
    upstream analysis reads); ``scope="all"`` is the whole order history
    (prior + train lines), which the upstream analysis could not hold in memory.
    """

    orders: DataFrame
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame
    order_products_prior: DataFrame
    order_products_train: DataFrame

    def lines(self, scope: str = "train") -> DataFrame:
        if scope == "train":
            return self.order_products_train
        if scope == "all":
            return self.order_products_prior.unionByName(self.order_products_train)
        raise ValueError(f"scope must be one of {SCOPES}, got {scope!r}")
