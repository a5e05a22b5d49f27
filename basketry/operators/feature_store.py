"""Line base bucketed by user: user measures and the joins back to the lines without a shuffle.

The store writes the lines once as a table that is bucketed and sorted by user, so
everything keyed by user (the distinct product count, the user measures, and both
joins back to the line grain) reads bucket against bucket: Spark plans no exchange
above the scans, however often the store is used.

A bucket cannot be split at run time, so users with very many lines do not belong
there. Users with more than 1 / ``HOT_USERS`` of all lines (at most ``HOT_USERS`` of
them, whatever the data) are kept in a second, ordinary table; their measures are
partial aggregates and are broadcast back to their lines.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.joins import broadcast_bounded_by
from basketry.operators import features as fe
from basketry.session import materialize
from basketry.sources.tables import Tables

HOT_USERS = 1024
LEAST_HOT = 10_000     # lines below which a user is never hot


@dataclass
class UserStore:
    """``name``: bucketed table of the usual users; ``hot``: lines of the others (NULL if there are none)."""

    name: str
    usual: DataFrame
    hot: DataFrame | None

    def all(self) -> DataFrame:
        return self.usual if self.hot is None else self.usual.unionByName(self.hot)


def build_store(base: DataFrame, path: str, buckets: int | None = None, least_hot: int = LEAST_HOT) -> UserStore:
    """Write ``base`` under ``path`` as a table bucketed by user_id; hot users' lines go to a table of their own."""
    spark = base.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = materialize(base.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), "user_lines")
    total = counts.agg(F.sum("n")).first()[0] or 0
    heavy = counts.where((F.col("n") > least_hot) & (F.col("n") * HOT_USERS > total)).select("user_id")
    usual, hot = base, None
    if not heavy.isEmpty():
        usual = base.join(F.broadcast(heavy), "user_id", "left_anti")
        hot = materialize(base.join(F.broadcast(heavy), "user_id", "left_semi").select(*base.columns), "hot_user_lines")
    name = f"user_store_{uuid.uuid4().hex}"
    (usual.select(*base.columns).repartition(buckets, "user_id").write.bucketBy(buckets, "user_id").sortBy("user_id")
     .option("path", path).format("parquet").saveAsTable(name))
    return UserStore(name, spark.table(name), hot)


def user_features(store: UserStore) -> DataFrame:
    """G6 of all users."""
    usual = fe.user_features(store.usual)
    return usual if store.hot is None else usual.unionByName(fe.user_features(store.hot))


def with_user_unique_products(store: UserStore) -> DataFrame:
    """G2 + J6."""
    usual = fe.with_user_unique_products(store.usual)
    if store.hot is None:
        return usual
    counts = F.broadcast(fe.user_unique_products(store.hot))   # at most HOT_USERS rows
    return usual.unionByName(store.hot.join(counts, "user_id").select(*usual.columns))


def feature_table(store: UserStore, tables: Tables) -> DataFrame:
    """The feature table of :func:`basketry.operators.features.feature_table`, joined by user without a shuffle."""
    wide = broadcast_bounded_by(fe.product_feature_wide(store.all(), tables), tables.products)
    usual = fe.assemble(store.usual, wide, fe.user_features(store.usual))
    if store.hot is None:
        return usual
    return usual.unionByName(fe.assemble(store.hot, wide, F.broadcast(fe.user_features(store.hot))))
