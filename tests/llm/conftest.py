import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns whose names clash with the operators'."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        for name in ("digest", "id", "root", "gram", "bits", "shard", "kept", "size", "record", "tokens"):
            df = df.withColumn(name, F.lit("x"))
        return df
    return make
