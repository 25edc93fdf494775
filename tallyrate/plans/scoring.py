"""Batch scoring of a request table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoderModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrate.functions import scalars as S
from tallyrate.operators import features


def requests_of(cells: DataFrame) -> DataFrame:
    """Requests at the attempts' own locations, one per attempt."""
    return cells.select(
        S.scale_x(F.col("x_half")).alias("x_center_scaled"),
        S.scale_y(F.col("y_half")).alias("y_center_scaled"),
        "dist_bin", "margin_cat", "period")


def raw_requests_of(binned: DataFrame) -> DataFrame:
    """The same for a model of learned zones."""
    return binned.select(F.col("loc_x").cast("double").alias("x_center"),
                         F.col("loc_y").cast("double").alias("y_center"),
                         "dist_bin", "margin_cat", "period")


@dataclass(frozen=True)
class Expected:
    """What a saved pipeline takes: its inputs and the levels its encoder knows."""

    inputs: features.Inputs
    distances: int
    periods: int

    @property
    def scaled(self) -> bool:
        """Models of named zones take scaled inputs and clamped periods."""
        return self.inputs == features.SCALED_INPUTS


def expected_by(model: PipelineModel) -> Expected:
    encoder = next(s for s in model.stages if isinstance(s, OneHotEncoderModel))
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    sizes = dict(zip(encoder.getInputCols(), encoder.categorySizes))
    x, y, _, margin, _ = assembler.getInputCols()
    return Expected(features.Inputs(x, y, margin), sizes["dist_bin"], sizes["period"])


def scorable(expected: Expected) -> Column:
    """Complete, and with a distance bin and period the encoder knows."""
    known = (F.col("dist_bin").between(0, expected.distances - 1) & (F.col("period") >= 0)
             & F.col("margin_cat").isNotNull())
    if not expected.scaled:
        known = known & (F.col("period") < expected.periods)
    for name in (expected.inputs.x, expected.inputs.y):
        known = known & F.col(name).isNotNull() & ~F.isnan(name)
    return F.coalesce(known, F.lit(False))


def score(model: PipelineModel, requests: DataFrame,
          predict: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The requests with `prediction` and the same as percent text. A request
    that cannot be scored keeps its row and gets neither. The pipeline itself says whether it
    takes `schemas.REQUESTS` or `schemas.RAW_REQUESTS`. `predict` stands in for the model's own
    `transform`, as `trees.with_prediction` does."""
    expected = expected_by(model)
    usable = scorable(expected)

    def or_zero(value: Column) -> Column:
        return F.when(usable, value).otherwise(F.lit(0))

    margin, period = S.clamp_margin(F.col("margin_cat")), F.col("period")
    if expected.scaled:
        margin, period = S.scale_margin(margin), S.clamp_period(period)
    prepared = requests.select(
        F.struct("*").alias("request"), usable.alias("usable"),
        or_zero(F.col(expected.inputs.x)).alias(expected.inputs.x),
        or_zero(F.col(expected.inputs.y)).alias(expected.inputs.y),
        or_zero(F.col("dist_bin")).alias("dist_bin"),
        or_zero(margin).alias(expected.inputs.margin), or_zero(period).alias("period"))
    scored = (predict or model.transform)(prepared).select(
        "request.*", F.when(F.col("usable"), F.col("prediction")).alias("prediction"))
    return scored.withColumn("percent", F.when(
        F.col("prediction").isNotNull(), S.percent_text(F.col("prediction"))))
