"""Filters, joins and checks that match an event log to attempts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrate.functions import scalars as S
from tallyrate.storage import written_table

# Free-throw codes, and the texts of a counted attempt. The
# spaces in the pattern are significant.
EXCLUDED_CODES = (10, 11, 12)
ATTEMPT_PATTERN = "MISS | PTS"

# Copies one joined row is expanded to at a time.
COPIES = 1000


def first_per_game(rows: DataFrame, value: str, game: str, order: str) -> DataFrame:
    """A column's value in the first row of each game."""
    return rows.groupBy(game).agg(F.min_by(value, order).alias(value))


def subject_side(subject: str, at_home: Column, home: str, visitor: str) -> Column:
    """Whether the description of the subject's own side names the subject."""
    return S.contains_or_false(F.when(at_home, F.col(home)).otherwise(F.col(visitor)), subject)


def without_codes(log: DataFrame, code: str, excluded: Sequence[int] = EXCLUDED_CODES) -> DataFrame:
    return log.where(S.not_in_or_null(F.col(code), excluded))


def either_side_matches(log: DataFrame, home: str, visitor: str,
                        pattern: str = ATTEMPT_PATTERN) -> DataFrame:
    return log.where(S.matches_or_false(F.col(home), pattern)
                     | S.matches_or_false(F.col(visitor), pattern))


def with_known_keys(log: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in `keys`. The keys are reduced to distinct ones and
    written, so a hot key is one row and the join side's size is exact."""
    return log.join(written_table(keys.select(key).distinct(), "known-keys"), key, "left_semi")


def attach(rows: DataFrame, lookup: DataFrame, key: str, value: str) -> DataFrame:
    """Left join in which each copy of a key in `lookup` yields a row.

    Equal (key, value) copies travel as one counted row per `COPIES` of them and
    are expanded after the join, so a hot key is not shuffled copy by copy.
    """
    counted = lookup.where(F.col(key).isNotNull()).groupBy(key, value).agg(
        F.count(F.lit(1)).alias("_n"))
    chunks = counted.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / COPIES))))
    copies = F.least(F.lit(COPIES).cast("bigint"), F.col("_n") - F.col("_chunk") * COPIES)
    lookup_rows = chunks.select(key, value, copies.cast("int").alias("_copies"))
    joined = rows.join(lookup_rows, key, "left")
    repeats = F.array_repeat(F.lit(0), F.coalesce(F.col("_copies"), F.lit(1)))
    return joined.withColumn("_copy", F.explode(repeats)).drop("_copies", "_copy")


def differing_counts(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Keys whose row counts differ between two tables, as `from` and `to`.

    One grouping of both inputs; a key absent from a table has a null count.
    """
    both = first.select(key, F.lit(True).alias("_first")).unionByName(
        second.select(key, F.lit(False).alias("_first")))
    counts = both.groupBy(key).agg(
        F.nullif(F.count_if(F.col("_first")), F.lit(0)).alias("from"),
        F.nullif(F.count_if(~F.col("_first")), F.lit(0)).alias("to"))
    return counts.where(~F.col("from").eqNullSafe(F.col("to")))
