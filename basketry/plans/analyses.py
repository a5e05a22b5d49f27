"""The three analyses end to end, on any :class:`~basketry.sources.Tables`.

1. :func:`basket_rules` - top-N products, their baskets, rules, top rules.
2. :func:`build_feature_table` - the feature table, written as Parquet.
3. :func:`train_and_evaluate` - split, boosted trees, threshold, outcome
   shares, confusion matrix and the per-user product lists.
"""

from __future__ import annotations

from dataclasses import dataclass

from typing import Any

from pyspark.sql import DataFrame

from basketry.config import LABEL_COL, ROUNDS_FIRST, ROUNDS_SECOND, TOP_RULES, ModelParams, RuleParams
from basketry.operators import baskets as bk
from basketry.operators import boosting as bo
from basketry.operators import evaluate as ev
from basketry.operators import features as fe
from basketry.operators import model as mo
from basketry.operators import recommend as rc
from basketry.operators import rules as ru
from basketry.operators import split as sp
from basketry.session import materialize
from basketry.sources.tables import Tables


def basket_frame(tables: Tables, scope: str, top_n: int) -> DataFrame:
    """Baskets of product names over the lines of the ``top_n`` products."""
    freq = bk.frequent_order_lines(tables.lines(scope), top_n)
    return bk.baskets(bk.lines_with_products(freq, tables.products))


@dataclass
class RuleResult:
    baskets: DataFrame
    rules: DataFrame
    top: DataFrame


def basket_rules(tables: Tables, scope: str = "train", params: RuleParams = RuleParams(),
                 miner: str = "fpgrowth") -> RuleResult:
    # the baskets feed the basket count, the item counts and the miner: write them once
    b = materialize(basket_frame(tables, scope, params.top_n), "baskets")
    if miner == "pairs":
        rules = ru.pair_rules(b, params.min_support, params.min_confidence)
    else:
        rules = ru.fpgrowth_rules(b, params.min_support, params.min_confidence, params.max_items)
    return RuleResult(b, rules, ru.top_rules(rules, TOP_RULES, params.min_lift))


def build_feature_table(tables: Tables, path: str | None = None, scope: str = "train") -> DataFrame:
    """Feature table; when ``path`` is given it is written there (Parquet) and read back,
    which also cuts the lineage before model fitting."""
    ft = fe.feature_table(tables, scope)
    if path is None:
        return ft
    ft.write.mode("overwrite").parquet(path)
    return ft.sparkSession.read.parquet(path)


@dataclass
class ModelResult:
    model: Any                # scores the outcome share
    final: Any                # scores the confusion matrix and the lists
    scored: DataFrame         # by the final model
    outcome: DataFrame
    confusion: DataFrame
    metrics: DataFrame
    predicted_vs_actual: DataFrame
    submission: DataFrame


def train_and_evaluate(features: DataFrame, products: DataFrame, params: ModelParams = ModelParams(),
                       final_params: ModelParams | None = None, learner: Any = mo) -> ModelResult:
    """Fit, score and evaluate as upstream: a first model gives the outcome share, a second one with
    ``final_params`` (70 rounds by default of the analysis, see :func:`reorder_model`) the confusion
    matrix and the lists. Without ``final_params`` one model does both. ``learner`` is a module with
    ``fit`` and ``score``: Spark ML's trees or :mod:`~basketry.operators.boosting`."""
    train = sp.split_train(features, params.train_percent).drop("eval_set")
    test = sp.split_holdout(features, params.train_percent).drop("eval_set")
    model = learner.fit(train, params)
    final_params = final_params or params
    final = model if final_params == params else learner.fit(train, final_params)
    first = ev.threshold(learner.score(model, test), mo.SCORE_COL, params.threshold)
    scored = ev.threshold(learner.score(final, test), mo.SCORE_COL, final_params.threshold)
    counts = ev.confusion_counts(scored, LABEL_COL)
    return ModelResult(
        model=model, final=final, scored=scored, outcome=ev.outcome_share(first), confusion=counts,
        metrics=ev.confusion_metrics(counts, positive=0),
        predicted_vs_actual=rc.predicted_vs_actual(scored, products),
        submission=rc.submission_list(scored))


def reorder_model(features: DataFrame, products: DataFrame) -> ModelResult:
    """The reorder analysis with upstream's two models of second-order trees: 50 rounds, then 70."""
    return train_and_evaluate(features, products, ModelParams(rounds=ROUNDS_FIRST), ModelParams(rounds=ROUNDS_SECOND), bo)
