"""From raw attempts to the scalar columns that make up a cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrate.functions import scalars as S

CELL = ("zone", "dist_bin", "margin_cat", "period")
FLAG = "shot_made_flag"


def with_cells(attempts: DataFrame) -> DataFrame:
    """Folded location, named zone, distance bin, margin category, clamped period."""
    x, y = F.col("loc_x").try_cast("int"), F.col("loc_y").try_cast("int")
    return attempts.withColumns({
        "x_half": S.fold_x(x),
        "y_half": S.fold_y(x, y),
        "zone": S.concat_zone(F.col("shot_zone_basic"), F.col("shot_zone_area")),
        "dist_bin": S.distance_bin(F.col("defender_distance")),
        "margin_cat": S.margin_category(F.col("scoremargin")),
        "period": S.clamp_period(F.col("period")),
    })


def in_half_court(attempts: DataFrame, column: str = "loc_y") -> DataFrame:
    """Drop attempts from beyond half court, and those without a location."""
    return attempts.where(F.col(column) < S.HALF_LENGTH)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def incomplete_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows each column, and any of them, would drop."""
    any_missing: Column = F.lit(False)
    for name in columns:
        any_missing = any_missing | F.col(name).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(any_missing).alias("incomplete"),
        *[F.count_if(F.col(name).isNull()).alias(f"missing_{name}") for name in columns],
    )
