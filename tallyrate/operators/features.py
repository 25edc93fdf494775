"""Feature encoding as Spark ML stages, shared by training and scoring."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import (MaxAbsScaler, OneHotEncoder, OneHotEncoderModel, StringIndexer,
                                VectorAssembler, VectorIndexer)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrate.functions import scalars as S
from tallyrate.operators.indexing import frequency_index
from tallyrate.storage import written_table

DISTANCE_LEVELS = len(S.DISTANCE_THRESHOLDS) + 1
MAX_CATEGORIES = 4


@dataclass(frozen=True)
class Inputs:
    """Numeric columns of the feature vector beside the two one-hot blocks."""

    x: str
    y: str
    margin: str


SCALED_INPUTS = Inputs("x_center_scaled", "y_center_scaled", "margin_scaled")
RAW_INPUTS = Inputs("x_center", "y_center", "margin_cat")


def level_encoder(spark: SparkSession, levels: Mapping[str, int],
                  outputs: Sequence[str] | None = None) -> OneHotEncoderModel:
    """One slot per level of each column, levels 0..n-1, none dropped.

    Fitted on the number of levels instead of on data: no pass over the rows, and a level absent
    from the training rows keeps its slot.
    """
    largest = spark.createDataFrame([tuple(n - 1 for n in levels.values())],
                                    ", ".join(f"`{name}` int" for name in levels))
    return OneHotEncoder(inputCols=list(levels),
                         outputCols=list(outputs or (f"{name}_onehot" for name in levels)),
                         dropLast=False).fit(largest)


def one_hot_encoder(spark: SparkSession, last_period: int = S.LAST_PERIOD) -> OneHotEncoderModel:
    """The two one-hot blocks of the models."""
    return level_encoder(spark, {"dist_bin": DISTANCE_LEVELS, "period": last_period + 1},
                         ["dist_onehot", "period_onehot"])


def assembler(inputs: Inputs = SCALED_INPUTS) -> VectorAssembler:
    """x, y, distance one-hot (7), margin, period one-hot (6): 16 features."""
    return VectorAssembler(inputCols=[inputs.x, inputs.y, "dist_onehot", inputs.margin,
                                      "period_onehot"],
                           outputCol="features", handleInvalid="error")


def max_abs_scaler() -> MaxAbsScaler:
    return MaxAbsScaler(inputCol="features", outputCol="scaled_features")


def vector_indexer(input_col: str) -> VectorIndexer:
    """Index features of at most four values as categories."""
    return VectorIndexer(inputCol=input_col, outputCol="indexed_features",
                         maxCategories=MAX_CATEGORIES, handleInvalid="keep")


def string_indexer(columns: Sequence[str]) -> StringIndexer:
    """Frequency index as a pipeline stage, ties by label. It gathers the labels
    on the driver, so it is for label sets known to be small."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"{name}_index" for name in columns],
                         stringOrderType="frequencyDesc")


def index_in_place(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace label columns by their frequency index, whatever the number of
    labels; a missing label stays missing."""
    for name in columns:
        ranks = written_table(frequency_index(df, name, "_rank").drop("n"), "label-ranks")
        df = df.join(ranks, name, "left").drop(name).withColumnRenamed("_rank", name)
    return df


def level_flags(column: str, levels: Sequence, prefix: str) -> list[Column]:
    """One 0/1 column per level; of labels, the column is named by the label's letters and digits."""
    return [F.when(F.col(column) == level, F.lit(1)).otherwise(F.lit(0)).alias(
        prefix + re.sub("[^0-9A-Za-z]+", "_", str(level))) for level in levels]


def one_hot_labels(df: DataFrame, levels: Mapping[str, Sequence]) -> DataFrame:
    """`df` with one 0/1 column per level of each column, whether rows have it or not."""
    return df.select("*", *(flag for column, values in levels.items()
                            for flag in level_flags(column, values, f"{column}_")))
