"""Column-wise scaling by the largest absolute value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def max_abs_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale into [-1, 1]; an all-zero column stays zero.

    The maxima are scalar subqueries of one aggregate over the input.
    """
    scaled = {}
    for name in columns:
        largest = df.agg(F.max(F.abs(F.col(name))).cast("double")).scalar()
        scaled[f"{name}_scaled"] = F.when(largest == 0, F.lit(0.0)).otherwise(F.col(name) / largest)
    return df.withColumns(scaled)
