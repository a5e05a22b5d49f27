from basketry.operators import evaluate as ev
from basketry.operators import recommend as rc
from basketry.operators import split as sp
from basketry.sources import sinks


def test_percent_text(spark):
    df = spark.createDataFrame([(100.0,), (77.1,), (77.125,), (0.0,)], "x double")
    from pyspark.sql import functions as F
    got = [r[0] for r in df.select(ev.percent_text(F.bround("x", 2))).collect()]
    assert got == ["100 %", "77.1 %", "77.12 %", "0 %"]


def test_outcome_share(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(0, 1)], "reordered int, prediction int")
    got = {r["sucesso"]: (r["contagem"], r["acertos_pct"], r["acertos_texto"])
           for r in ev.outcome_share(df).collect()}
    assert got == {"sim": (3, 75.0, "75 %"), "não": (1, 25.0, "25 %")}


def test_confusion_corners(spark):
    all0 = spark.createDataFrame([(0, 1), (0, 1), (0, 0)], "prediction int, reordered int")
    cells = {(r["prediction"], r["reference"]): r["n"] for r in ev.confusion_counts(all0).collect()}
    assert cells == {(0, 0): 1, (0, 1): 2, (1, 0): 0, (1, 1): 0}
    m = ev.confusion_metrics(ev.confusion_counts(all0)).first()
    assert abs(m["accuracy"] - 1 / 3) < 1e-12 and m["sensitivity"] == 1.0 and m["specificity"] == 0.0
    assert m["neg_pred_value"] is None  # no row predicted 1
    empty = spark.createDataFrame([], "prediction int, reordered int")
    assert sum(r["n"] for r in ev.confusion_counts(empty).collect()) == 0
    assert ev.confusion_metrics(ev.confusion_counts(empty)).first()["accuracy"] is None


def test_threshold_inclusive(spark):
    df = spark.createDataFrame([(0.7,), (0.6999,)], "s double")
    assert [r["prediction"] for r in ev.threshold(df, "s", 0.7).collect()] == [1, 0]


def test_lists_keep_duplicates_in_product_order(spark):
    scored = spark.createDataFrame([(1, 12, 1, 1), (1, 10, 1, 1), (1, 12, 1, 0), (2, 11, 0, 1)],
                                   "user_id long, product_id long, prediction int, reordered int")
    prods = spark.createDataFrame([(10, "a, x"), (11, "b"), (12, "c")], "product_id long, product_name string")
    got = {r["user_id"]: r["produtos_previstos"] for r in rc.predicted_products(scored, prods).collect()}
    assert got == {1: "a, x, c, c"}
    sub = {r["user_id"]: r["produtos"] for r in rc.submission_list(scored).collect()}
    assert sub == {1: "10 12 12"}
    both = rc.predicted_vs_actual(scored, prods).collect()
    assert [(r["user_id"], r["produtos_reais"]) for r in both] == [(1, "a, x, c")]


def test_csv_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a, "quoted", b'), (2, "plain")], "user_id long, produtos string")
    path = str(tmp_path / "lists")
    sinks.write_csv(df, path)
    back = sinks.read_csv(spark, path, "user_id long, produtos string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_split_partitions_rows(spark):
    data = [(u, o, p, c) for u in range(1, 30) for o in range(1, 4) for p in (3, 8) for c in (1, 2)]
    df = spark.createDataFrame(data, "user_id long, order_number int, product_id long, add_to_cart_order int") \
        .withColumn("reordered", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1))
    tr, ho = sp.split_train(df), sp.split_holdout(df)
    assert tr.count() + ho.count() == df.count()
    assert tr.intersect(ho).count() == 0


def test_stratified_split_exact_shares(spark):
    from pyspark.sql import functions as F
    data = [(u, o, p, c, 1 if (u * 7 + p) % 5 == 0 else 0)
            for u in range(1, 40) for o in range(1, 4) for p in (3, 8, 11) for c in (1, 2)]
    df = spark.createDataFrame(data, "user_id long, order_number int, product_id long, add_to_cart_order int, "
                                     "reordered int")
    tr, ho = sp.split_stratified(df), sp.split_stratified(df, train=False)
    assert tr.count() + ho.count() == df.count() and tr.intersect(ho).count() == 0
    import math
    for cls, n in {r["reordered"]: r["count"] for r in df.groupBy("reordered").count().collect()}.items():
        assert tr.filter(F.col("reordered") == cls).count() == math.ceil(n * 0.8)


def test_mcnemar_without_difference_is_zero(spark):
    def statistic(b, c):
        rows = [(0, 0)] * 4 + [(0, 1)] * b + [(1, 0)] * c + [(1, 1)] * 5
        return ev.confusion_metrics(ev.confusion_counts(
            spark.createDataFrame(rows, "prediction int, reordered int"))).first()["mcnemar_statistic"]

    assert statistic(3, 3) == 0.0 and statistic(0, 0) is None
    assert abs(statistic(6, 2) - 9 / 8) < 1e-12 and abs(statistic(3, 2) - 0.0) < 1e-12


def test_product_without_name_is_listed_as_missing(spark):
    scored = spark.createDataFrame([(1, 10, 1, 1), (1, 11, 1, 1)],
                                   "user_id long, product_id long, prediction int, reordered int")
    prods = spark.createDataFrame([(10, None), (11, "b")], "product_id long, product_name string")
    assert rc.predicted_products(scored, prods).first()["produtos_previstos"] == "NA, b"
