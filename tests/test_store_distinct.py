import uuid

import pytest
from pyspark.sql import functions as F

from basketry.operators import distinct as di
from basketry.operators import feature_store as fs
from basketry.operators import features as fe
from basketry.plans.registry import normalise
from basketry.session import materialize
from basketry.sources.fixtures import tpch_tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def base(spark):
    tables = tpch_tables(spark, "/root/testdata/sf0.001", materialize_tables=True)
    return tables, materialize(fe.occurrence_line_base(tables, "all"), "line_base")


def rows(df):
    return sorted(map(str, normalise(df).select(*sorted(df.columns)).collect()))


def test_user_joins_read_buckets_without_an_exchange(spark, base, tmp_path, monkeypatch):
    tables, lines = base
    monkeypatch.setitem(fs.__dict__, "LEAST_HOT", 10)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as for tables that are too large to broadcast
    try:
        store = fs.build_store(lines, str(tmp_path / uuid.uuid4().hex), 4)
        assert store.hot is None
        counted = fs.with_user_unique_products(store)
        assert "Exchange hashpartitioning" not in plan(counted) and "SortMergeJoin" in plan(counted)
        users = fe.user_features(store.usual)
        assert "Exchange" not in plan(users)
        joined = store.usual.join(users, "user_id", "left")
        assert "Exchange" not in plan(joined)
        assert rows(counted) == rows(fe.with_user_unique_products(lines))
        assert rows(fs.feature_table(store, tables)) == rows(fe.feature_table(tables, "all", base=lines))
        spark.sql(f"DROP TABLE {store.name}")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_users_are_kept_apart(spark, base, tmp_path, monkeypatch):
    tables, lines = base
    monkeypatch.setattr(fs, "HOT_USERS", 120)   # of 150 users: some hold more than 1 / 120 of the lines
    store = fs.build_store(lines, str(tmp_path / "store"), 3, least_hot=10)
    assert 0 < store.hot.count() < lines.count()
    assert store.hot.join(store.usual, "user_id", "left_semi").count() == 0
    assert rows(fs.with_user_unique_products(store)) == rows(fe.with_user_unique_products(lines))
    assert rows(fs.user_features(store)) == rows(fe.user_features(lines))
    assert rows(fs.feature_table(store, tables)) == rows(fe.feature_table(tables, "all", base=lines))
    spark.sql(f"DROP TABLE {store.name}")


ODD = [(1, None, 0.0), (1, None, 0.0), (None, "1", 0.0), (None, "1", -0.0), (None, None, None), (None, None, None),
       (1, "a", float("nan")), (1, "a", float("nan")), (1, "a", None), (2, "", 1.5), (2, None, 1.5), (2, "b", 1.5)]


@pytest.mark.parametrize("collide", [False, True])
def test_distinct_rows(spark, monkeypatch, collide):
    if collide:  # every row has the same digest: the contents decide
        monkeypatch.setattr(di, "row_digest", lambda df: (F.lit(1), F.lit(2)))
    df = spark.createDataFrame(ODD, "a int, b string, c double").repartition(3)
    df = materialize(df, "odd")
    assert rows(di.distinct_rows(df)) == rows(df.distinct()) and df.distinct().count() == 8
    assert di.distinct_rows(df.limit(0)).count() == 0


def test_a_row_of_many_copies_is_a_few_partial_rows(spark):
    df = materialize(spark.range(0, 200_000, 1, 4).select((F.col("id") * 0).alias("x"), F.lit("same").alias("y"))
                     .unionByName(spark.range(5).select(F.col("id").alias("x"), F.lit("other").alias("y"))), "hot")
    out = di.distinct_rows(df)
    assert out.count() == 6
    text = plan(out)
    assert "partial_" not in text.split("BroadcastHashJoin")[0]   # the rows themselves are not aggregated
