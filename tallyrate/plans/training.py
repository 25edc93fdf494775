"""Fit on the training rows of a rate table and judge on the rest."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrate.operators import features, models
from tallyrate.storage import fixed_order_table


def fit_and_predict(rates: DataFrame, pipeline: Pipeline) -> tuple[PipelineModel, DataFrame]:
    """The fitted pipeline and its predictions for the held-out rows. Every pass
    of the fit reads `rates` again, so it should be a stored table."""
    model = pipeline.fit(rates.where("is_train"))
    return model, model.transform(rates.where("NOT is_train"))


def train_zone_model(rates: DataFrame, regressor) -> tuple[PipelineModel, DataFrame]:
    """Named zones: scaled inputs straight into the regressor."""
    stored = fixed_order_table(rates, "rates")
    return fit_and_predict(stored, models.pipeline(stored.sparkSession, regressor))


def train_cluster_model(rates: DataFrame, regressor) -> tuple[PipelineModel, DataFrame]:
    """Learned zones or a stored rate table of such: raw inputs, scaled by the
    largest value and category-indexed before the regressor."""
    stored = fixed_order_table(rates, "rates")
    last_period = stored.agg(F.max("period")).first()[0]
    return fit_and_predict(stored, models.pipeline(
        stored.sparkSession, regressor, features.RAW_INPUTS, scale=True, index=True,
        last_period=last_period))
