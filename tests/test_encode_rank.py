import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.functions.encode import binary_encode, bit_width
from basketry.operators.ranking import block_row_number


def test_bit_width():
    assert [bit_width(n) for n in (1, 2, 3, 4, 5, 8, 9, 25, 134)] == [1, 1, 2, 2, 3, 3, 4, 5, 8]


def test_encoder_levels_and_null(spark):
    for n in (1, 2, 3, 4, 5, 8):
        vals = [(i, f"v{i}") for i in range(n)]
        out = binary_encode(spark.createDataFrame(vals, "id int, c string"), ["c"])
        bits = [c for c in out.columns if c.startswith("c_bin_")]
        assert len(bits) == bit_width(n)
        codes = {tuple(r[b] for b in bits) for r in out.collect()}
        # distinct codes per level, except that the top level wraps to zeros when n is a power of 2
        assert len(codes) == n
    out = binary_encode(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, c string"), ["c"])
    got = {r["id"]: (r["c_bin_1"], r["c_bin_2"]) for r in out.collect()}
    assert got == {1: (0, 1), 2: (1, 0), 3: (0, 0)}


def test_block_row_number_matches_row_number_with_hot_key(spark):
    rnd = random.Random(7)
    data = [(0 if rnd.random() < 0.4 else rnd.randint(1, 20), rnd.randint(1, 300), rnd.randint(1, 5), i)
            for i in range(3000)]
    df = spark.createDataFrame(data, "g int, k int, t int, id int")
    got = block_row_number(df, ["g"], ["k", "t", "id"], F.col("k"), 16, "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k", "t", "id")))
    assert sorted(map(tuple, got.select("id", "rn").collect())) == sorted(map(tuple, want.select("id", "rn").collect()))


def test_block_row_number_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), (1, 5, 3), (1, 3, 4)], "g int, k int, id int")
    got = block_row_number(df, ["g"], ["k", "id"], F.col("k"), 2, "rn")
    assert sorted(map(tuple, got.select("id", "rn").collect())) == [(1, 1), (2, 2), (3, 2), (4, 1)]


def test_block_row_number_null_groups_and_null_blocks(spark):
    rnd = random.Random(3)
    data = [(rnd.choice([None, "a", ""]), rnd.choice([None, 0, 1, 5, 9]), rnd.choice([None, 1, 2]), i) for i in range(400)]
    df = spark.createDataFrame(data, "g string, k int, t int, id int")
    got = block_row_number(df, ["g"], ["k", "t", "id"], [F.col("k"), F.col("t")], [1, 2], "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k", "t", "id")))
    assert got.count() == 400
    assert sorted(map(tuple, got.select("id", "rn").collect())) == sorted(map(tuple, want.select("id", "rn").collect()))


def test_one_huge_order_is_split(spark):
    """All lines in one order of one user and product: the window sees blocks of cart positions, not the order."""
    from basketry.operators import features as fe
    lines = spark.range(0, 20000).selectExpr("7L AS user_id", "3L AS product_id", "1 AS order_number",
                                             "CAST(id + 1 AS INT) AS add_to_cart_order", "9L AS order_id")
    got = fe.with_occurrence_number(lines)
    assert got.where("user_buy_product_times <> add_to_cart_order").count() == 0 and got.count() == 20000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__blk1" in plan


def test_encoder_numbers_levels_across_partitions(spark):
    from basketry.functions.encode import level_codes
    vals = [f"level {i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "c string").repartition(13)
    codes, n = level_codes(df, "c")
    got = {r["__level"]: r["__code"] for r in codes.collect()}
    assert n == 1001 and got == {v: i + 1 for i, v in enumerate(sorted(vals))}


def test_occurrence_number_of_large_and_ordinary_users(spark, monkeypatch):
    """Large users go in blocks, the others through one window, NULL users included; numbers as one window gives them."""
    from pyspark.sql import Window

    from basketry.operators import features as fe
    monkeypatch.setattr(fe, "USER_LINES", 50)
    lines = spark.range(0, 600).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1L WHEN id % 7 = 0 THEN NULL ELSE id % 40 END AS user_id", "id % 4 AS product_id",
        "CAST(id % 5 AS INT) AS order_number", "CAST(id AS INT) AS add_to_cart_order", "id AS order_id")
    w = Window.partitionBy("user_id", "product_id").orderBy("order_number", "add_to_cart_order", "order_id")
    want = {tuple(r) for r in lines.withColumn("n", F.row_number().over(w)).collect()}
    assert {tuple(r) for r in fe.with_occurrence_number(lines).collect()} == want


def test_order_tables_by_window_and_by_block(spark, tmp_path, monkeypatch):
    """Numbering and first orders are the same whether a user's or an order's rows are one window or taken in blocks."""
    from basketry.operators import ranking
    from basketry.sources.fixtures import tpch_tables

    orders = [(o, o % 4 or None, f"2020-01-{1 + o % 9:02d}") for o in range(40)] + [(7, 3, "2020-01-08"), (50, 1, None)]
    lines = [(o % 41, p, 1, n % 3 if n else None, 1.0, 2.0, 0.0, 0.0, "2020-02-01")
             for o in range(60) for n, p in enumerate([o % 5, (o + 1) % 6, o % 5, None, 3])] + [(None, 1, 1, 1, 1.0, 2.0, 0.0, 0.0, None)]
    parts = [(p, f"n{p}", f"Brand#1{p % 3}" if p != 2 else None, "ABC"[p % 3]) for p in range(5)] + [(1, "n1", "Brand#11", "B")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, d string").selectExpr(
        "o_orderkey", "o_custkey", "cast(d as timestamp) as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, d string").selectExpr(
        "* except (d)", "cast(d as timestamp) as l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(
        f"{tmp_path}/part.parquet")

    def found():
        t = tpch_tables(spark, str(tmp_path), materialize_tables=True)
        return sorted(map(str, t.orders.collect())), sorted(map(str, t.lines("all").collect()))

    by_window = found()
    assert len(by_window[0]) == 42 and by_window[1]
    monkeypatch.setattr(ranking, "GROUP_ROWS", 3)
    assert found() == by_window


def test_lines_are_not_ordered_by_what_does_not_tell_them_apart(spark):
    """The lines' shuffles carry order, number, part and product only, unless a part has two products."""
    from basketry.sources import fixtures

    lines = spark.createDataFrame([(1, 1, 1, 1, 1.0, 2.0, 0.0, 0.0, None)], "l_orderkey long, l_partkey long, l_suppkey long, "
                                  "l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                                  "l_shipdate timestamp")
    one = spark.createDataFrame([(1, 5), (1, 5), (2, 6)], "p_partkey long, product_id long")
    two = spark.createDataFrame([(1, 5), (1, 6)], "p_partkey long, product_id long")
    plans = [fixtures._numbered_lines(lines, p)._jdf.queryExecution().optimizedPlan().toString() for p in (one, two)]
    assert "Window" in plans[0] and ["l_extendedprice" in p.split("Window")[1].splitlines()[0] for p in plans] == [False, True]
    assert fixtures._numbered_lines(lines, one).count() == 2
