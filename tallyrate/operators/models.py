"""Regression stages, pipelines and their storage."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import (GBTRegressor, RandomForestRegressionModel,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame, SparkSession

from tallyrate.operators import features
from tallyrate.functions.scalars import LAST_PERIOD

LABEL = "fg"
SEED = 42


def forest(seed: int = SEED, trees: int = 20, depth: int = 5, bins: int = 32) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=LABEL, numTrees=trees, maxDepth=depth, maxBins=bins,
                                 impurity="variance", seed=seed)


def small_forest(seed: int = SEED) -> RandomForestRegressor:
    return forest(seed, trees=15, depth=4)


def boosted(seed: int = SEED, iterations: int = 10, step: float = 0.1, depth: int = 5) -> GBTRegressor:
    return GBTRegressor(labelCol=LABEL, maxIter=iterations, stepSize=step, maxDepth=depth,
                        lossType="squared", seed=seed)


def pipeline(spark: SparkSession, regressor, inputs: features.Inputs = features.SCALED_INPUTS,
             scale: bool = False, index: bool = False, last_period: int = LAST_PERIOD) -> Pipeline:
    """Encoder, assembler, optional scaler and indexer, regressor - all fitted on
    the training rows and saved together, so scoring cannot encode differently."""
    stages = [features.one_hot_encoder(spark, last_period), features.assembler(inputs)]
    column = "features"
    if scale:
        stages.append(features.max_abs_scaler())
        column = "scaled_features"
    if index:
        stages.append(features.vector_indexer(column))
        column = "indexed_features"
    return Pipeline(stages=[*stages, regressor.setFeaturesCol(column)])


def rmse(predictions: DataFrame) -> float:
    return RegressionEvaluator(labelCol=LABEL, predictionCol="prediction",
                               metricName="rmse").evaluate(predictions)


def regressor_of(model: PipelineModel):
    """The fitted regression model at the end of a pipeline."""
    return model.stages[-1]


def save(model, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_forest(path: str) -> RandomForestRegressionModel:
    """A forest saved without its pipeline; it predicts from the feature vector."""
    return RandomForestRegressionModel.load(path)
