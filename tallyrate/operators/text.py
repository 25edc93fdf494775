"""Line counts over text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines_of(texts: DataFrame, column: str) -> DataFrame:
    """The lines of each text, ended by `\\n`, `\\r\\n` or `\\r` as in a text file:
    a final line end opens no further line, and an empty text has none."""
    line_end = F.lit("\n")
    ends = F.replace(F.replace(F.col(column), F.lit("\r\n"), line_end), F.lit("\r"), line_end)
    body = F.when(ends.endswith("\n"), F.left(ends, F.length(ends) - 1)).otherwise(ends)
    return texts.where(F.col(column) != "").select(F.explode(F.split(body, "\n")).alias("value"))


def contains_counts(lines: DataFrame, needles: Sequence[str]) -> DataFrame:
    """Lines that contain each needle, in one pass over the lines."""
    return lines.agg(*[F.count_if(F.col("value").contains(needle)).alias(f"lines_with_{needle}")
                       for needle in needles])
