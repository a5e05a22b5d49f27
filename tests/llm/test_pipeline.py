import re
import sys

import pytest
from brute import contained, near_components
from harness import compare
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from basketry.llm import op01_bpe, op09_quality
from basketry.llm.queries import llm_sql

TEN = [f"op{n}_" for n in range(1, 11)]


def test_entry_registers_one_query_per_operator():
    names = list(E.queries())
    for prefix in TEN:
        assert len([n for n in names if n.startswith(prefix)]) == 1
    assert "pipeline" in names and set(llm_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(llm_sql()))
def test_query_matches_its_sql(spark, sf_small, key):
    ok, msg = compare(E.queries()[key](spark, sf_small), E.oracle_sql()[key], sf_small)
    assert ok, msg


def test_stages_follow_brute_force(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        rows = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, sf_small)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        left = [r.doc_id for r in out.collect()]
        if name == "quality":
            want = [r.doc_id for r in op09_quality.classify(docs, labels).collect() if r.kept]
        elif name == "exact_dedup":
            best = {}
            for d, t in rows.items():
                key = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
                best[key] = max(d, best.get(key, d))
            want = list(best.values())
        elif name == "near_dedup":
            want = [d for d, _, c in near_components(sorted(rows.items())) if d == c]
        elif name == "decontaminate":
            want = [d for d, found in contained(sorted(rows.items()), items).items() if not found]
        else:
            want = list(rows)
            assert {r.doc_id: r.text for r in op01_bpe.decode_ids(out).collect()} == rows
        assert sorted(left) == sorted(want), name
        if name != "tokenise":
            assert out.columns == columns
            docs = out


def test_modules_do_not_hide_missing_imports():
    assert corpus_pipeline.ORACLE_SQL is None and corpus_pipeline.STAGES[0][0] == "quality"
    assert "basketry.llm" in sys.modules


TEXTS = ["the river runs below the old house and the garden is quiet in the evening light of the valley",
         "a small hill stands above the water and the trees behind it walk down to the morning shore",
         "people of the town bring bread and fruit to the market before the sun is over the roofs again"]


def write_tables(spark, folder, rows, trusted):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("digest", "id", "root", "node", "kept", "gram", "shard"):
        docs = docs.withColumn(name, F.lit("x"))
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, TEXTS[2])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_run_on_odd_rows(spark, tmp_path):
    """NULL ids, one id for several texts, repeated rows and clashing names: only what a stage rejects goes."""
    rows = [(1, TEXTS[0], "en"), (1, TEXTS[0], "en"),           # repeated row
            (2, "", "en"), (2, TEXTS[1], "en"),                 # one id, one text without words
            (None, None, "en"), (None, TEXTS[1] + " far away from here", None),   # no id, one without text
            (7, TEXTS[2], "en"), (8, "So " + TEXTS[2], "en"),   # benchmark item
            (9, TEXTS[0].upper(), "en")]                        # equal text
    rows = [(*r, "s", None) for r in rows]
    out = corpus_pipeline.run(spark, write_tables(spark, tmp_path, rows, [1, 2, 7, 8, 9]))
    texts = sorted((r.doc_id or 0, r.text) for r in op01_bpe.decode_ids(out).collect())
    assert texts == [(0, TEXTS[1] + " far away from here"), (2, TEXTS[1]), (9, TEXTS[0].upper())]


def test_run_on_empty_tables(spark, tmp_path):
    out = corpus_pipeline.run(spark, write_tables(spark, tmp_path, [], []))
    assert out.count() == 0 and {"doc_id", "token_ids", "n_tokens"} <= set(out.columns)


def test_workers_give_back_what_they_keep(spark, make_docs):
    """Tables kept from task to task are gone after a stage, and what needs them works again."""
    import pyarrow as pa

    from basketry.llm.common import give_back_memory

    def held(batches):
        from basketry.llm import op01_bpe as worker
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([len(worker._codecs)], pa.int64())], ["n"])

    docs = make_docs([(1, "some words"), (2, None)])
    assert len(op01_bpe.round_trip(docs).collect()) == 2
    give_back_memory(spark)
    assert spark.range(0, 8, 1, 8).mapInArrow(held, "n long").agg(F.sum("n")).first()[0] == 0
    assert len(op01_bpe.round_trip(docs).collect()) == 2


def test_all_idle_workers_give_back(spark):
    """Tasks that chain several Python steps leave several idle workers at each place; all of them are reached."""
    import time

    import pyarrow as pa

    from basketry.llm.common import give_back_memory
    from basketry.session import ship_package

    def fill(batches):
        from basketry.llm import op01_bpe as worker
        worker._codecs[-1] = None
        time.sleep(0.3)
        yield from batches

    def held(batches):
        from basketry.llm import op01_bpe as worker
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([len(worker._codecs)], pa.int64())], ["n"])

    ship_package(spark)
    tasks = spark.sparkContext.defaultParallelism
    rows = spark.range(0, tasks, 1, tasks)
    for _ in range(4):
        rows = rows.mapInArrow(fill, "id long")
    assert rows.count() == tasks
    give_back_memory(spark)
    assert spark.range(0, 8 * tasks, 1, 8 * tasks).mapInArrow(held, "n long").agg(F.sum("n")).first()[0] == 0


def test_more_idle_workers_than_a_round_of_tasks_give_back(spark, monkeypatch):
    """Workers beyond one round are reached too, and tokenising leaves no tables in any worker."""
    import time

    import pyarrow as pa

    from basketry.llm import common

    def fill(batches):
        from basketry.llm import op01_bpe as worker
        worker._codecs[-1] = None
        time.sleep(0.3)
        yield from batches

    def held(batches):
        from basketry.llm import op01_bpe as worker
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([len(worker._codecs)], pa.int64())], ["n"])

    common.ship_package(spark)
    tasks = spark.sparkContext.defaultParallelism
    rows = spark.range(0, tasks, 1, tasks)
    for _ in range(4):
        rows = rows.mapInArrow(fill, "id long")
    assert rows.count() == tasks
    monkeypatch.setattr(common, "TURNS", 1)
    common.give_back_memory(spark)
    left = spark.range(0, 12 * tasks, 1, 12 * tasks).mapInArrow(held, "n long")
    assert left.agg(F.sum("n")).first()[0] == 0
    docs = spark.range(0, 2 * tasks, 1, tasks).selectExpr("id doc_id", "concat('some words of ', id) text")
    assert op01_bpe.token_rows(docs).count() == 2 * tasks
    assert left.agg(F.sum("n")).first()[0] == 0
