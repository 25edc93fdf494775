"""Seeded train/test splits that depend on the key alone.

The bucket of a row is a hash of its key columns, so a split survives
re-partitioning and retried tasks, and all rows of a key land on one side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1000
TRAIN_SHARE = 0.7


def bucket(keys: Sequence[str], seed: int) -> Column:
    """0..999 from the md5 of seed and keys; any engine can compute it."""
    parts = [F.coalesce(F.col(key).cast("string"), F.lit("null")) for key in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % BUCKETS).cast("int")


def with_split(df: DataFrame, keys: Sequence[str], seed: int,
               share: float = TRAIN_SHARE, name: str = "is_train") -> DataFrame:
    taken = round(share * BUCKETS)
    if not 0 <= share <= 1 or (0 < share < 1 and taken in (0, BUCKETS)):
        raise ValueError(f"a share of {share} leaves one side of the split empty; the step is 1/{BUCKETS}")
    return df.withColumn(name, bucket(keys, seed) < taken)


def split(df: DataFrame, keys: Sequence[str], seed: int,
          share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, keys, seed, share, "_train")
    return marked.where("_train").drop("_train"), marked.where("NOT _train").drop("_train")
