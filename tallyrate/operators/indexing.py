"""Dense row numbers over a sorted table, without a single sorting task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrate.storage import written_table

# monotonically_increasing_id keeps the row's place in its partition in this many bits.
PLACE_BITS = 33


def dense_index(df: DataFrame, order: Sequence[Column], name: str = "index") -> DataFrame:
    """Number rows 0, 1, 2, ... in the given order, which must not have ties.

    Rows are range-partitioned and sorted in place; a row's number is its place
    in its partition plus the size of the partitions before. The sizes are one
    row per shuffle partition, so broadcasting them is bounded.
    """
    placed = written_table(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
          .withColumn("_id", F.monotonically_increasing_id()), "sorted-rows")
    part = F.shiftright("_id", PLACE_BITS)
    place = F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(
        name, F.col("_start") + place).select(*df.columns, name)


def frequency_index(df: DataFrame, column: str, name: str = "index") -> DataFrame:
    """Labels with their count and rank: most frequent first, then by label."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n"))
    return dense_index(counts, [F.col("n").desc(), F.col(column)], name)
