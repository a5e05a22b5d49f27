"""Writers: feature table (Parquet), per-user lists (quoted CSV with header).

Upstream wrote unquoted CSV, which is ambiguous once product names are joined
by ", "; lists are written quoted here and read back equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketry.functions.nulls import is_na


def write_parquet(df: DataFrame, path: str) -> None:
    """K1: overwrite ``path`` with ``df`` as Parquet."""
    df.write.mode("overwrite").parquet(path)


def write_observed(df: DataFrame, path: str) -> DataFrame:
    """Q1, Q2 on the way of K1: write ``df`` to ``path``; ``column, na_count, n_rows`` of what was written.

    The counts are metrics of the writing job itself, one number a column, so no
    second scan is needed. Spark adds up the tasks that succeeded.
    """
    seen = Observation()
    counts = [F.count_if(is_na(c, t)).alias(f"c{i}") for i, (c, t) in enumerate(df.dtypes)]
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *counts), path)
    got = seen.get
    return df.sparkSession.createDataFrame([(c, got[f"c{i}"], got["n_rows"]) for i, c in enumerate(df.columns)],
                                           "`column` string, na_count long, n_rows long")


def write_csv(df: DataFrame, path: str) -> None:
    """K2 / K3: overwrite ``path`` with a header row, every text field quoted."""
    (df.write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("escape", '"').csv(path))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("multiLine", True).csv(path))
