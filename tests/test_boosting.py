import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.config import ModelParams
from basketry.operators import boosting as bo

COLS = ["a", "b", "c", "d"]


def rows(seed=7, n=1000):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n), rng.integers(0, 9, n).astype(float)
    c, d = rng.exponential(size=n) * 100, rng.integers(0, 2, n).astype(float)
    a[rng.random(n) < 0.15] = np.nan
    b[rng.random(n) < 0.1] = np.nan
    y = ((np.nan_to_num(a, nan=0.8) + 0.3 * np.nan_to_num(b, nan=-2) - c / 90 + rng.normal(size=n)) > 0.4).astype(int)
    return np.stack([a, b, c, d], axis=1), y


def table(spark, x, y):
    data = [(*(None if np.isnan(v) and i == 1 else float(v) for i, v in enumerate(r)), int(t)) for r, t in zip(x, y, strict=True)]
    return spark.createDataFrame(data, "a double, b double, c double, d double, reordered int")


def brute_fit(x, y, edges, params):
    """Trees by trying every cut of every feature with plain sums."""
    score, trees = np.full(len(y), bo.FIRST_SCORE), []
    for _ in range(params.rounds):
        g, tree, todo = score - y, {}, [(1, np.arange(len(y)))]
        while todo:
            node, at = todo.pop()
            best = None
            if node < 1 << params.depth:
                total = g[at].sum() ** 2 / (len(at) + 1)
                for f, cuts in enumerate(edges):
                    v = x[at, f]
                    for cut in cuts:
                        for missing_left in (True, False):
                            left = np.where(np.isnan(v), missing_left, v <= cut)
                            if not left.any() or left.all():
                                continue
                            gain = (g[at[left]].sum() ** 2 / (left.sum() + 1) + g[at[~left]].sum() ** 2 / ((~left).sum() + 1)
                                    - total)
                            if gain > bo.MIN_GAIN and (best is None or gain > best[0] + 1e-6):
                                best = (gain, f, cut, missing_left, left)
            if best is None:
                weight = -g[at].sum() / (len(at) + 1) * params.learning_rate
                tree[node] = weight
                score[at] += weight
            else:
                _, f, cut, missing_left, left = best
                tree[node] = (COLS[f], cut, missing_left)
                todo += [(2 * node, at[left]), (2 * node + 1, at[~left])]
        trees.append(tree)
    return trees, score


def test_same_trees_as_brute_force(spark):
    x, y = rows()
    df = table(spark, x, y)
    params = ModelParams(rounds=4, depth=4)
    edges = bo.bin_edges(df, COLS)
    assert edges[3] == [0.0] and edges[1] == [float(i) for i in range(8)] and len(edges[0]) == bo.BINS - 2
    want, scores = brute_fit(x, y, edges, params)
    model = bo.fit(df, params, cols=COLS)
    for tree, nodes in zip(want, model.trees, strict=True):
        assert {n.node for n in nodes} == set(tree)
        for n in nodes:
            if n.feature is None:
                assert abs(n.leaf - tree[n.node]) < 1e-5
            else:
                assert (n.feature, n.cut, n.missing_left) == tree[n.node]
    got = sorted(r[0] for r in bo.score(model, df).select("score").collect())
    assert np.allclose(got, np.sort(scores), atol=1e-4)


def test_neither_partitions_nor_order_nor_a_start_change_the_model(spark):
    x, y = rows(3, 600)
    df = table(spark, x, y)
    params = ModelParams(rounds=5, depth=3, checkpoint_interval=2)
    model = bo.fit(df, params, cols=COLS)
    assert bo.fit(df.repartition(7).orderBy(F.rand(1)), params, cols=COLS) == model
    short = bo.fit(df, ModelParams(rounds=2, depth=3), cols=COLS)
    assert short.trees == model.trees[:2]
    assert bo.fit(df, params, cols=COLS, start=short) == model


def test_saved_model_scores_bit_for_bit(spark, tmp_path):
    x, y = rows(5, 400)
    df = table(spark, x, y)
    model = bo.fit(df, ModelParams(rounds=6, depth=5), cols=COLS)
    bo.save(spark, model, str(tmp_path / "m"))
    loaded = bo.load(spark, str(tmp_path / "m"))
    assert loaded == model
    scored = bo.score(loaded, bo.score(model, df, "first"), "second")
    assert scored.where("first = second").count() == 400
    # walking the nodes by hand gives the same scores
    by = [{n.node: n for n in t} for t in model.trees]
    for r in scored.limit(50).collect():
        total = model.first
        for nodes in by:
            n = nodes[1]
            while n.feature is not None:
                v = r[n.feature]
                left = n.missing_left if v is None or np.isnan(v) else v <= n.cut
                n = nodes[2 * n.node + (not left)]
            total += n.leaf
        assert total == r["first"]


@pytest.mark.parametrize("label", [0, 1])
def test_odd_tables(spark, label):
    same = spark.createDataFrame([(1.0, None, 3, label)] * 20, "a double, b double, c int, reordered int")
    model = bo.fit(same, ModelParams(rounds=2, depth=3))
    assert [len(t) for t in model.trees] == [1, 1]   # nothing to split
    assert bo.fit(same.limit(0), ModelParams(rounds=2)).trees == ()
    assert [r[0] for r in bo.score(bo.TreeModel(()), same.limit(1)).select("score").collect()] == [bo.FIRST_SCORE]
    assert bo.from_table(bo.model_table(spark, bo.TreeModel(()))) == bo.TreeModel(())


def test_driver_gets_splits_not_sums(spark, monkeypatch):
    """However many tasks add up gradients, what the driver collects for a level stays small."""
    import pickle

    x, y = rows(n=400)
    df = table(spark, x, y).repartition(40)
    sent, collect = [], bo.RDD.collect

    def counted(self):
        out = collect(self)
        sent.append(len(pickle.dumps(out)))
        return out

    monkeypatch.setattr(bo.RDD, "collect", counted)
    model = bo.fit(df, ModelParams(rounds=2, depth=5), cols=COLS)
    assert len(model.trees) == 2 and len(sent) == 10
    assert max(sent) < 20_000


def test_packed_sums_equal_plain_sums(monkeypatch):
    rng = np.random.default_rng(3)
    widths = np.array([5, 3, 64])
    bins = np.stack([rng.integers(0, w, 5000) for w in widths], axis=1).astype(np.uint8)
    block = (bins, rng.integers(0, 2, 5000).astype(float), rng.normal(size=5000))
    codes = np.full(8, -1)
    codes[1] = (2 * 128 + 30) * 2 + 1
    packed = [bo._sums([block, block], codes, level, widths) for level in (0, 1)]
    monkeypatch.setattr(bo, "PACKED_ROWS", 0)
    for level, got in enumerate(packed):
        assert (bo._sums([block, block], codes, level, widths) == got).all()
    assert packed[1][1].sum() == 2 * 5000 * 3 and (packed[1][0].sum(axis=0) == packed[0][0, 0]).all()
