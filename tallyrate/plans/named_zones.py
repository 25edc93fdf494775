"""Rates over named zones, split into training and test cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrate.functions import scalars as S
from tallyrate.operators import rates as R
from tallyrate.operators.cells import CELL, FLAG, drop_incomplete, with_cells
from tallyrate.operators.split import TRAIN_SHARE, with_split
from tallyrate.operators.zones import centroids_of_counts, join_centroids
from tallyrate.storage import written_table

REQUIRED = ("dist_bin", "margin_cat", "period", FLAG)


def zone_rates(attempts: DataFrame, seed: int, key: Sequence[str],
               split_level: str = "attempt", share: float = TRAIN_SHARE,
               min_support: int = R.MIN_SUPPORT, outcomes: str = "made",
               centroids_from: str = "all") -> DataFrame:
    """Rate rows with `is_train` and the model inputs.

    Attempts are read and shuffled once, into cells that carry the coordinate
    sums; zone centres, support, rates and scaling all follow from the cells.
    `split_level` is "attempt" (by `key`, before counting; each side needs its
    own support) or "cell" (by cell, after counting). `centroids_from` is "all"
    or "train".
    """
    cells = drop_incomplete(with_cells(attempts), REQUIRED)
    if split_level == "attempt":
        counted = R.cell_table(with_split(cells, key, seed, share), ("is_train", *CELL),
                               ("x_half", "y_half"))
    elif split_level == "cell":
        counted = with_split(R.cell_table(cells, CELL, ("x_half", "y_half")), CELL, seed, share)
    else:
        raise ValueError(f"split_level must be 'attempt' or 'cell', not {split_level!r}")
    counted = written_table(counted, "zone-cells")

    centre_rows = counted if centroids_from == "all" else counted.where("is_train")
    located = join_centroids(R.rates_of(counted, min_support, outcomes),
                             centroids_of_counts(centre_rows))
    rated = with_model_inputs(located)
    flag = [FLAG] if outcomes == "both" else []
    return drop_incomplete(rated.select(
        "is_train", *CELL, *flag, "shots", "total", "fg", "x_center", "y_center",
        "x_center_scaled", "y_center_scaled", "margin_scaled"), ("x_center", "y_center"))


def with_model_inputs(located: DataFrame) -> DataFrame:
    return located.withColumns({
        "x_center_scaled": S.scale_x(F.col("x_center")),
        "y_center_scaled": S.scale_y(F.col("y_center")),
        "margin_scaled": S.scale_margin(F.col("margin_cat")),
    })
