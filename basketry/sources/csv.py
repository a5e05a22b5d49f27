"""Reader for the CSV layout of the public grocery-order dataset."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from basketry.sources import schemas
from basketry.sources.tables import Tables


def read_csv_tables(spark: SparkSession, root: str) -> Tables:
    """Read the six CSV files under ``root`` with fixed schemas (no inference).

    Empty ``days_since_prior_order`` cells (first orders) become NULL.
    """
    frames = {}
    for key, (fname, schema) in schemas.FILES.items():
        frames[key] = (spark.read.schema(schema)
                       .option("header", True)
                       .option("mode", "FAILFAST")
                       .csv(os.path.join(root, fname)))
    return Tables(**frames)


def read_parquet_tables(spark: SparkSession, root: str) -> Tables:
    """Same tables stored as Parquet folders named after the table keys."""
    frames = {key: spark.read.schema(schema).parquet(os.path.join(root, key))
              for key, (_, schema) in schemas.FILES.items()}
    return Tables(**frames)
