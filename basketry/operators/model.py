"""Boosted regression trees on the feature table (Spark ML).

Upstream trains gradient-boosted trees with squared-error loss (no objective
given), depth 6, learning rate 0.3, 50 and then 70 rounds, on every column but
the label and ``eval_set``; ids are features too. ``GBTRegressor`` is the Spark
counterpart; scores are regression outputs and may leave [0, 1].
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame

from basketry.config import LABEL_COL, ModelParams
from basketry.session import ensure_checkpoint_dir

FEATURES_COL = "features"
SCORE_COL = "score"


def feature_columns(df: DataFrame, exclude=ModelParams().exclude) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def assembler(cols: list[str]) -> VectorAssembler:
    """M2: all feature columns into one vector (missing values kept as NaN)."""
    return VectorAssembler(inputCols=cols, outputCol=FEATURES_COL, handleInvalid="keep")


def gbt(params: ModelParams) -> GBTRegressor:
    return GBTRegressor(featuresCol=FEATURES_COL, labelCol=LABEL_COL, predictionCol=SCORE_COL,
                        maxIter=params.rounds, maxDepth=params.depth, stepSize=params.learning_rate,
                        lossType="squared", maxBins=params.max_bins, seed=params.seed,
                        checkpointInterval=params.checkpoint_interval, cacheNodeIds=False)


def fit(train: DataFrame, params: ModelParams = ModelParams()) -> PipelineModel:
    """M3 / M4: assembler + boosted trees fitted on ``train``.

    The running predictions are checkpointed every ``checkpoint_interval``
    rounds into the session's shared checkpoint folder, which keeps the
    lineage of the iterations short. Trees are passed to the executors rather
    than caching a node id per row: at depth 6 that was about 35% faster
    (measured at sf0.1), and it keeps no per-row state between rounds.
    """
    ensure_checkpoint_dir(train.sparkSession)
    cols = feature_columns(train, params.exclude)
    label = train.withColumn(LABEL_COL, train[LABEL_COL].cast("double"))
    return Pipeline(stages=[assembler(cols), gbt(params)]).fit(label)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M5: ``df`` with a ``score`` column (the vector column is dropped)."""
    return model.transform(df).drop(FEATURES_COL)


def save(model: PipelineModel, path: str) -> None:
    """K4: write the fitted model (overwrites)."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
