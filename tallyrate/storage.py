"""Written intermediate tables in the cluster's shared folder.

Derived join sides and training tables are written once and read back. The file
size is then known exactly, so Spark's own threshold decides between a
broadcast and a shuffle join whose skewed partitions adaptive execution can
split; the lineage ends at the files, so a lost executor costs no re-run of the
whole input.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a temporary folder only for an unset local session."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.TemporaryDirectory(
            prefix="tallyrate-", ignore_cleanup_errors=True)
    return _local_folders[context.applicationId].name


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tallyrate-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


class Scope:
    """The tables written since it was opened, and how often each may still be read.

    A table written with a number of readers goes when the last of them is written. The others,
    and all that is left, go when the scope closes, except what `keep` took out of it.
    """

    def __init__(self, spark: SparkSession, outer: Scope | None):
        self.spark, self.outer = spark, outer
        self.readers: dict[str, int | None] = {}

    def tables(self) -> list[str]:
        return sorted(self.readers)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a result that outlives the scope, and read it from there. It belongs to the
        scope outside, if there is one."""
        kept = written_table(df, name)
        for path in _read_by(kept, self.readers):
            del self.readers[path]
            if self.outer is not None:
                self.outer.readers[path] = None
        return kept

    def _count(self, df: DataFrame) -> None:
        scope = self
        while scope is not None:
            counted = [path for path, left in scope.readers.items() if left is not None]
            for path in _read_by(df, counted):
                scope.readers[path] -= 1
                if not scope.readers[path]:
                    scope._drop(path)
            scope = scope.outer

    def _drop(self, path: str) -> None:
        del self.readers[path]
        _delete(self.spark, path)


_open: list[Scope] = []


def _read_by(df: DataFrame, paths) -> list[str]:
    """Which of these tables the frame's plan reads."""
    paths = list(paths)
    if not paths:
        return []
    names = {path.rsplit("/", 1)[1]: path for path in paths}
    return [names[name] for name in {file.rsplit("/", 2)[-2] for file in df.inputFiles()} if name in names]


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """Tables written inside are dropped at its end, also when it fails."""
    found = Scope(spark, _open[-1] if _open else None)
    _open.append(found)
    try:
        yield found
    finally:
        _open.remove(found)
        for path in found.tables():
            found._drop(path)


def written_table(df: DataFrame, name: str, readers: int | None = None, by: str | None = None) -> DataFrame:
    """Write `df` once and read it from there. Inside a `scope`, a table with a number of
    `readers` is dropped once so many tables that read it have been written; a reader counts
    once, however often its plan reads the table. With `by`, the last column, each of its values has a
    folder, and who asks for some values reads these alone."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=by)
    _register(df, path, readers)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def separate_unions(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside keep every partition of a union a task of its own. Spark 4.1 would make
    one task of frames that are each in one partition."""
    name = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _register(df: DataFrame, path: str, readers: int | None) -> None:
    if _open:
        _open[-1]._count(df)
        _open[-1].readers[path] = readers


def bucket_keys(spark: SparkSession, buckets: int) -> list[int]:
    """For each bucket an integer that Spark's bucketing puts there, so that numbered partitions can be
    written one to a bucket. The list is as long as the number of shuffle partitions."""
    found: dict[int, int] = {}
    start, step = 0, 16 * buckets + 64
    while len(found) < buckets:
        rows = spark.range(start, start + step, 1, 1).select(
            F.col("id").cast("int").alias("key"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(buckets)).alias("bucket"))
        for bucket, key in rows.groupBy("bucket").agg(F.min("key")).collect():
            found.setdefault(bucket, key)
        start += step
    return [found[bucket] for bucket in range(buckets)]


def placed_table(df: DataFrame, name: str, by: str, order: Sequence[str], buckets: int) -> DataFrame:
    """A written table that keeps its placement: bucketed by the column `by` and sorted in each bucket
    by `by` and `order`, so that grouping, windows and joins by `by`, and by `by` with other
    columns, read it without another exchange. `df` should be partitioned by `by` already, else
    every task writes a file to every bucket."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    table = f"tallyrate_{path.rsplit('-', 1)[1]}"
    df.write.bucketBy(buckets, by).sortBy(by, *order).option("path", path).saveAsTable(table)
    _register(df, path, None)
    _tables.setdefault(_application_folder(spark), {})[path] = table
    return spark.table(table)


# Catalog names of placed tables, by application and path.
_tables: dict[str, dict[str, str]] = {}


# Partitions that a seeded fit reads at least, and rows for which it gets another one. The draws of
# a fit depend on the partitions, so their number follows the rows and not the machine.
FIT_PARTITIONS, FIT_ROWS = 16, 500_000


def fixed_order_table(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """A written table whose rows are read in the same partition and order on any cluster.
    Seeded fits draw rows by place, so they repeat only on such a table. The placing follows
    the reading, which packs files by size and cores."""
    keys = [field.name for field in df.schema if isinstance(field.dataType, T.AtomicType)]
    table = written_table(df, name)
    if partitions is None:
        partitions = max(FIT_PARTITIONS, -(-table.count() // FIT_ROWS))
    return table.repartition(partitions, *keys).sortWithinPartitions(*keys)


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle starts with."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or usual)


def drop_written_tables(spark: SparkSession) -> None:
    """Delete what this application wrote; frames read from it end here too."""
    for path in list(_tables.get(_application_folder(spark), ())):
        _delete(spark, path)
    _delete(spark, _application_folder(spark))


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _delete(spark: SparkSession, path: str) -> None:
    table = _tables.get(_application_folder(spark), {}).pop(path, None)
    if table is not None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
