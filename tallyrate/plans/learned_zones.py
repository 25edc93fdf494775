"""Rates over zones learned by clustering the locations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrate.functions import scalars as S
from tallyrate.operators import rates as R
from tallyrate.operators.cells import FLAG, drop_incomplete, in_half_court
from tallyrate.operators.split import TRAIN_SHARE, with_split
from tallyrate.operators.zones import CLUSTERS, assign_zones, fit_zones
from tallyrate.storage import fixed_order_table, written_table

POINT_CELL = ("loc_x", "loc_y", "dist_bin", "margin_cat", "period")
REQUIRED = (*POINT_CELL, FLAG)
CELL = ("x_center", "y_center", "dist_bin", "margin_cat", "period")


def binned(attempts: DataFrame) -> DataFrame:
    """Attempts of the half court with bins, located to whole feet as named zones are."""
    return in_half_court(attempts).withColumns({
        "loc_x": F.col("loc_x").try_cast("int"), "loc_y": F.col("loc_y").try_cast("int"),
        "dist_bin": S.distance_bin(F.col("defender_distance")),
        "margin_cat": S.margin_category(F.col("scoremargin")),
    })


def cluster_rates(attempts: DataFrame, seed: int, k: int = CLUSTERS,
                  min_support: int = R.MIN_SUPPORT, outcomes: str = "both",
                  share: float = TRAIN_SHARE) -> DataFrame:
    """Rate rows of cells around k learned centres, split by cell.

    Attempts are counted per location and bins first, in one pass. Clustering,
    assignment and the regrouping by centre then work on that table, whose size
    is set by the court and the bins. Periods are not clamped here.
    """
    points = written_table(
        R.cell_table(drop_incomplete(binned(attempts), REQUIRED), POINT_CELL), "point-cells")
    weighted = fixed_order_table(
        points.groupBy("loc_x", "loc_y").agg(F.sum("total").alias("weight")), "points")
    placed = assign_zones(points, fit_zones(weighted, seed, k)).withColumns({
        "x_center": F.round("x_center", 2), "y_center": F.round("y_center", 2)})
    counted = placed.groupBy(*CELL).agg(F.sum("total").alias("total"), F.sum("made").alias("made"))
    return with_split(R.rates_of(counted, min_support, outcomes), CELL, seed, share)
