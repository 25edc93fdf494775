"""Error of predicted rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rmse(predicted: DataFrame, label: str = "fg", prediction: str = "prediction") -> DataFrame:
    """One row: root mean squared error and the number of rows behind it."""
    error = F.col(prediction) - F.col(label)
    return predicted.agg(F.sqrt(F.avg(error * error)).alias("rmse"),
                         F.count(F.lit(1)).alias("n"))


def mean_baseline(rates: DataFrame, label: str = "fg") -> DataFrame:
    """Predict every row by the mean label."""
    return rates.withColumn("prediction", rates.agg(F.avg(label)).scalar())
