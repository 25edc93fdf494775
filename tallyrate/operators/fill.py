"""Forward fill of an ordered log within each group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrate.storage import bucket_keys, placed_table, shuffle_partitions


def forward_fill(log: DataFrame, value: str, group: str, order: str, default: str = "0") -> DataFrame:
    """Missing values take the last earlier one of their group, or `default`.

    Rows are range-partitioned by group and order, so a large group lies in several partitions,
    one after the other, and each partition is filled by itself. The partitions are written one to a
    bucket, so the log is exchanged once. Only the first group of a partition can go on from an
    earlier one, of which it is then the last group: what is carried over comes from two rows a
    partition and is broadcast. Null orders come first. Of rows with the same order those with a
    value come first, by value.
    """
    spark = log.sparkSession
    places = [F.col(group), F.col(order), F.col(value).asc_nulls_last()]
    partitions = shuffle_partitions(spark)
    keys = F.split(F.lit(",".join(map(str, bucket_keys(spark, partitions)))), ",").cast("array<int>")
    ranged = placed_table(
        log.repartitionByRange(partitions, *places).withColumn("_at", F.spark_partition_id()).withColumn("_part", F.get(keys, "_at")),
        "ranged-log", "_part", [group, order], partitions)
    so_far = Window.partitionBy("_part", group).orderBy(order, F.col(value).asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    filled = ranged.withColumn(value, F.last(value, ignorenulls=True).over(so_far))

    ends = ranged.groupBy("_part").agg(
        F.first("_at").alias("_at"), F.min(F.struct(F.col(group).alias("g"))).alias("_first"),
        F.max(F.struct(F.col(group).alias("g"))).alias("_final"),
        F.max(F.when(F.col(value).isNotNull(), F.struct(
            F.col(group).alias("g"), F.col(order).alias("o"), F.col(value).alias("v")))).alias("_held"))
    given = F.when(F.col("_held.g").eqNullSafe(F.col("_final.g")), F.col("_held.v"))
    rows = ends.select(F.explode(F.array(
        F.struct(F.col("_final.g").alias("_group"), "_part", "_at", given.alias("_given"), F.lit(False).alias("_takes")),
        F.struct(F.col("_first.g").alias("_group"), "_part", "_at", F.lit(None).cast(log.schema[value].dataType).alias("_given"),
                 F.lit(True).alias("_takes")))).alias("row")).select("row.*")
    before = Window.partitionBy("_group").orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    carried = rows.withColumn("_carried", F.last("_given", ignorenulls=True).over(before)).where(
        "_takes and _carried is not null").select("_group", F.col("_part").alias("_into"), "_carried")
    return filled.join(
        F.broadcast(carried), F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_into")), "left",
    ).withColumn(value, F.coalesce(value, "_carried", F.lit(default))).select(*log.columns)
