from pyspark.sql import functions as F

from basketry.config import ModelParams
from basketry.operators import boosting as bo


def table(spark, n=600):
    """a has gaps, c is a in other words, d is constant, e has a's cuts but differs in one row."""
    df = spark.range(n).select("id", F.when(F.col("id") % 11 > 0, (F.col("id") * 37 % n).cast("double")).alias("a"),
                               (F.col("id") * 29 % 7).alias("b"), ((F.col("id") * 37 % 5 < 2) | (F.col("id") % 13 == 4))
                               .cast("int").alias("reordered"))
    return df.withColumns({"c": F.coalesce("a", F.lit(float("nan"))), "d": F.lit(4),
                           "e": F.when((F.col("id") == 1) | F.col("a").isNull(), F.lit(None)).otherwise(F.col("a"))})


def test_cuts_are_distinct_values_or_quantiles(spark):
    """The quantiles are those of one aggregate over the whole column, on more rows than it keeps exactly."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, (F.col("id") * 7919 % 20_011) / 8.0).alias("many"),
                                    (F.col("id") % 50 - 0.0).alias("few"), F.lit(None).cast("double").alias("none"),
                                    F.lit(2).alias("one"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("heavy"),
                                    (F.col("id") % 100).alias("some")).coalesce(1)
    edges = bo.bin_edges(df, df.columns)
    shares = [(i + 1) / 63 for i in range(62)]
    for i in (0, 4, 5):
        q, last = df.agg(F.percentile_approx(F.col(df.columns[i]).cast("double"), shares, 10000), F.max(df.columns[i])).first()
        assert edges[i] == sorted({v for v in q if v < last}) and len(edges[i]) > 15
    assert edges[1] == [float(i) for i in range(49)] and edges[2] == edges[3] == []


def test_features_that_no_split_can_be_on_are_left_out(spark):
    df = table(spark)
    prepared = bo.prepare(df, cols=["a", "b", "c", "d", "e"])
    assert [prepared.cols[f] for f in prepared.used] == ["a", "b", "e"]
    params = ModelParams(rounds=3, depth=4)
    assert bo.fit(df, params, prepared=prepared) == bo.fit(df, params, cols=["a", "b", "e"])


def test_start_with_other_cuts_goes_on_from_its_scores(spark):
    df = table(spark).cache()
    start = bo.TreeModel(((bo.Node(1, 1, "a", 100.25, True, None, 1.0, 600), bo.Node(1, 2, leaf=0.125, n_rows=100),
                           bo.Node(1, 3, leaf=-0.25, n_rows=500)),))
    model = bo.fit(df, ModelParams(rounds=2, depth=1), cols=["a", "b"], start=start)
    assert model.trees[0] == start.trees[0]
    root = model.trees[1][0]
    side = F.coalesce(F.col(root.feature) <= root.cut, F.lit(root.missing_left))
    g = F.col("score") - F.col("reordered")
    want = {r.side: r for r in bo.score(start, df).groupBy(side.alias("side")).agg(F.sum(g).alias("g"), F.count("*").alias("n")).collect()}
    for leaf, left in zip(model.trees[1][1:], (True, False), strict=True):
        assert leaf.n_rows == want[left].n and abs(leaf.leaf + 0.3 * want[left].g / (want[left].n + 1)) < 1e-5


def test_both_models_of_a_query_share_their_bins(spark, sf_small, monkeypatch):
    from basketry.plans import registry as rg

    made, bin_edges = [], bo.bin_edges
    monkeypatch.setattr(bo, "bin_edges", lambda *a: made.append(a) or bin_edges(*a))
    monkeypatch.setattr(rg, "ROUNDS_FIRST", 2)
    monkeypatch.setattr(rg, "ROUNDS_SECOND", 4)
    context = rg.Context(spark, sf_small)
    monkeypatch.setattr(rg, "_ctx", lambda *_: context)
    counts = rg.q_model_confusion_counts(spark, sf_small).collect()
    assert len(made) == 1 and sum(r.n for r in counts) == context.holdout_scored(4).count()
    whole = bo.fit(rg.sp.split_train(context.features()).drop("eval_set"), ModelParams(rounds=4))
    assert context.model(4) == whole and context.model(2).trees == whole.trees[:2]
    context.release()


def test_scores_are_one_column_whatever_the_model(spark):
    df = table(spark, 50)
    leaf = (bo.Node(1, 1, leaf=0.25, n_rows=5),)
    assert {r.score for r in bo.score(bo.TreeModel((leaf, leaf)), df).collect()} == {1.0}
    stump = (bo.Node(1, 1, "c", 20.0, False, None, 1.0, 5), bo.Node(1, 2, leaf=1.0), bo.Node(1, 3, leaf=2.0))
    got = bo.score(bo.TreeModel((leaf, stump)), df).select(*df.columns, "score").collect()
    assert all(r.score == 0.75 + (1.0 if r.a is not None and r.a <= 20 else 2.0) for r in got)
