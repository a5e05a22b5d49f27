from pyspark.sql import functions as F

from basketry.functions.joins import bounded_broadcast, bounded_count, broadcast_bounded_by, null_safe_join
from basketry.session import scale_conf


def test_bounded_count_caps(spark):
    df = spark.range(0, 1000, numPartitions=8)
    assert bounded_count(df, 10) == 10
    assert bounded_count(df, 5000) == 1000
    assert bounded_count(df.filter("id < 0"), 10) == 0


def _is_broadcast(df) -> bool:
    return "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_broadcast_only_with_proof(spark):
    small, big = spark.range(10), spark.range(0, 5000, numPartitions=4)
    assert _is_broadcast(bounded_broadcast(small, max_rows=100))
    assert not _is_broadcast(bounded_broadcast(big, max_rows=100))
    agg = big.groupBy((F.col("id") % 7).alias("k")).count()
    assert _is_broadcast(broadcast_bounded_by(agg, small, max_rows=100))
    assert not _is_broadcast(broadcast_bounded_by(agg, big, max_rows=100))


def test_null_safe_join_matches_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, r string")
    got = sorted((r["l"], r["r"]) for r in null_safe_join(left, right, ["k"]).collect())
    assert got == [("a", "x"), ("b", "y")]


def test_scale_conf_bounds():
    tb = 1 << 40
    c = scale_conf(100 * tb)
    assert c["spark.sql.shuffle.partitions"] == "100000"
    assert scale_conf(1 << 30)["spark.sql.shuffle.partitions"] == "200"
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 << 20


def test_shared_folder_is_required_outside_local_mode(monkeypatch):
    import pytest

    from basketry import session

    class Context:
        def __init__(self, master):
            self.master, self.made = master, None

        def getCheckpointDir(self):
            return self.made

        def setCheckpointDir(self, path):
            self.made = path

        def getConf(self):
            return {}

    class Session:
        def __init__(self, master):
            self.sparkContext, self.conf = Context(master), {}

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session("spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session("local-cluster[3,2,1024]"))
    assert session.ensure_checkpoint_dir(Session("local[4]"))


def test_context_follows_its_files_and_leaves_no_copies(spark, tmp_path):
    import os
    import shutil

    from basketry.plans.registry import Context, query

    source, mine = "/root/testdata/sf0.001", tmp_path / "data"
    mine.mkdir()
    for name in ("orders", "lineitem", "part"):
        shutil.copyfile(f"{source}/{name}.parquet", mine / f"{name}.parquet")
    first = query("product_frequency")(spark, str(mine)).agg(F.sum("frequency")).first()[0]
    query("feature_table")(spark, str(mine)).count()
    held = list(Context.get(spark, str(mine)).paths)
    query("feature_table")(spark, str(mine)).count()
    assert Context.get(spark, str(mine)).paths == held  # the second call writes nothing anew
    lines = spark.read.parquet(f"{source}/lineitem.parquet").where("l_orderkey % 2 = 0").toPandas()
    lines.to_parquet(mine / "lineitem.parquet", coerce_timestamps="us")
    second = query("product_frequency")(spark, str(mine)).agg(F.sum("frequency")).first()[0]
    assert second == len(lines) < first
    assert not any(os.path.exists(p.removeprefix("file:")) for p in held)
    context = Context.get(spark, str(mine))
    left = list(context.paths)
    context.release()
    Context._cache = {k: v for k, v in Context._cache.items() if v[1] is not context}
    assert left and not any(os.path.exists(p.removeprefix("file:")) for p in left)
