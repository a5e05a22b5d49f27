"""Training-corpus pipeline: documents in, token ids out.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet to the shared folder and read
again as the next stage's ``docs``, so a lost executor costs one stage at most.
All stages but the last return the columns of ``documents``; the last one
returns the token ids of what is left. A stage first lets the Python workers give back
what the stage before left in them.

Each stage decides row by row: rows that share a doc_id (or have none) but not their
text are told apart by a digest of the text. Empty tables pass through; NULL or wordless texts are rejected by the
first stage. Extra columns of ``documents`` are carried to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import op01_bpe, op03_near, op06_exact, op07_contain, op09_quality
from basketry.llm.common import give_back_memory, table
from basketry.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    give_back_memory(spark)
    kept = op09_quality.drop_rejected(docs, table(spark, sf_dir, "labels"))
    give_back_memory(spark)   # the scoring is over before the kept rows are written
    return kept


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    give_back_memory(spark)
    return op06_exact.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest doc_id."""
    give_back_memory(spark)
    kept = op03_near.drop_near_copies(docs)
    give_back_memory(spark)
    return kept


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    give_back_memory(spark)
    return op07_contain.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token_ids and n_tokens of what is left."""
    give_back_memory(spark)
    return op01_bpe.token_rows(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokenise", tokenise),
]

# The quality model and the tokenizer have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
