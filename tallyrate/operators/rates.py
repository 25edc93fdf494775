"""Counts per cell and the success-rate table.

Every table here is one grouping of the attempts by scalar columns: partial
aggregation shrinks a hot cell to one row per map task, and the outcome rows are
unpivoted from the cell's two counters instead of being joined to its total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrate.functions import scalars as S
from tallyrate.operators.cells import CELL, FLAG

MIN_SUPPORT = 2


def outcome_counts(cells: DataFrame, cell: Sequence[str] = CELL) -> DataFrame:
    return cells.groupBy(*cell, FLAG).agg(F.count(F.lit(1)).alias("shots"))


def totals(cells: DataFrame, cell: Sequence[str] = CELL) -> DataFrame:
    return cells.groupBy(*cell).agg(F.count(F.lit(1)).alias("total"))


def cell_table(cells: DataFrame, cell: Sequence[str] = CELL,
               sums: Sequence[str] = ()) -> DataFrame:
    """Per cell: `total` attempts and `made` of them; for each further column its
    sum and the count of its values, from which means over cells can be taken."""
    further = [pair for name in sums for pair in (
        F.sum(name).alias(f"sum_{name}"), F.count(name).alias(f"count_{name}"))]
    return cells.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col(FLAG).cast("bigint")).alias("made"),
        *further,
    )


def supported(counted: DataFrame, min_support: int = MIN_SUPPORT) -> DataFrame:
    return counted.where(F.col("total") >= min_support)


def made_rates(counted: DataFrame) -> DataFrame:
    """One row per cell: the rate of success. A cell of misses only gets rate 0."""
    return counted.withColumnRenamed("made", "shots").withColumn(
        "fg", S.pct2(F.col("shots"), F.col("total")))


def outcome_rows(counted: DataFrame, keep: Column) -> DataFrame:
    """Unpivot `made`/`total` into one row per outcome, flag 0 and 1."""
    rows = F.array(
        F.struct(F.lit(0).alias(FLAG), (F.col("total") - F.col("made")).alias("shots")),
        F.struct(F.lit(1).alias(FLAG), F.col("made").alias("shots")),
    )
    others = [name for name in counted.columns if name != "made"]
    return counted.select(*others, F.inline(rows)).where(keep)


def counts_with_total(counted: DataFrame) -> DataFrame:
    """Observed outcomes only, each beside its cell's total."""
    return outcome_rows(counted, F.col("shots") > 0)


def both_rates(counted: DataFrame) -> DataFrame:
    """The rate of either outcome, with a zero-rate success row for all-miss cells."""
    rows = outcome_rows(counted, (F.col("shots") > 0) | (F.col(FLAG) == 1))
    return rows.withColumn("fg", S.pct2(F.col("shots"), F.col("total")))


def rates_of(counted: DataFrame, min_support: int = MIN_SUPPORT,
             outcomes: str = "made") -> DataFrame:
    """Rates of counted cells; `outcomes` is "made" (one row per cell) or "both"."""
    kept = supported(counted, min_support)
    if outcomes == "made":
        return made_rates(kept)
    if outcomes == "both":
        return both_rates(kept)
    raise ValueError(f"outcomes must be 'made' or 'both', not {outcomes!r}")


def rate_table(cells: DataFrame, cell: Sequence[str] = CELL, min_support: int = MIN_SUPPORT,
               outcomes: str = "made") -> DataFrame:
    """Rates per cell, straight from the attempts."""
    return rates_of(cell_table(cells, cell), min_support, outcomes)
