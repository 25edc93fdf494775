"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrate.storage import written_table

# What separates words in every operator that counts or cuts them.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def columns_of(df: DataFrame, **renamed: str) -> DataFrame:
    """Only the named columns, as `name=column`; others of any name are left out."""
    return df.select(*(F.col(f"`{column}`").alias(name) for name, column in renamed.items()))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "tallyrate_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | T.StructType) -> DataFrame:
    """`mapInArrow`, with this package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def release_memory() -> None:
    """Give freed memory back to the system: Python workers live on from stage to stage, and what
    earlier ones used would count beside what later ones need."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema)


def byte_sized(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20,
               ) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose text column holds about `limit` bytes; a longer text is
    a batch of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(
            zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def running_sums(df: DataFrame, order: list[Column], **sums: str) -> DataFrame:
    """Adds, for each `name=column`, the sum of `column` over all earlier rows in an order
    without ties. Rows are range-partitioned; only one row per partition meets in one place."""
    placed = written_table(df.repartitionByRange(*order).withColumn(
        "_part", F.spark_partition_id()), "ranged")
    here = Window.partitionBy("_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(*(F.sum(c).alias(f"_{n}") for n, c in sums.items()))
    starts = parts.select("_part", *(
        F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums))
    return placed.join(F.broadcast(starts), "_part").select(*df.columns, *(
        (F.col(f"_{n}") + F.coalesce(F.sum(c).over(here), F.lit(0))).alias(n)
        for n, c in sums.items()))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable from each linked node.

    Alternating large-star and small-star rounds: every round hangs all neighbours of a node on
    the least of them, until each component is one star. A round is a few grouped minima and
    joins over written tables, so a hub with many links is split by adaptive execution, and the
    number of rounds grows with the logarithm of the longest chain. Links to itself and
    repeated links change nothing; an empty table gives an empty one.
    """
    edges = written_table(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                          .where("u > v").distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.select("u", "v").union(edges.select("v", "u"))
        lowest = written_table(both.groupBy("u").agg(
            F.least("u", F.min("v")).alias("low")), "large-star")
        edges = written_table(both.join(lowest, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("low").alias("v")).distinct(), "large-links")
        lowest = written_table(edges.groupBy("u").agg(F.min("v").alias("low")), "small-star")
        edges = written_table(
            edges.join(lowest, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .union(lowest.select("u", F.col("low").alias("v"))).distinct(), "small-links")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Number and order-free digest of the links, to see when they stop changing."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", "u"))).first())


# Bits of a key filter: what is broadcast is at most an eighth as many bytes, at any input size.
FILTER_BITS = 1 << 24


def key_filter(keys: DataFrame, column: str) -> DataFrame:
    """A bitmap of fixed size over the long `column`, to leave rows out of a shuffle early."""
    place = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)) + 1
    return keys.select(F.bitmap_bucket_number(place).alias("_bucket"),
                       F.bitmap_bit_position(place).alias("_bit")).groupBy("_bucket").agg(
        F.bitmap_construct_agg("_bit").alias("_bits"))


def in_filter(rows: DataFrame, column: str, bitmap: DataFrame) -> DataFrame:
    """Adds `_maybe`: false only where the key is surely not in the filter."""
    place = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)) + 1
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return rows.withColumn("_bucket", F.bitmap_bucket_number(place)).join(
        F.broadcast(bitmap), "_bucket", "left").withColumn("_maybe", F.coalesce(
            F.getbit(byte.cast("int"), (bit % 8).cast("int")) == 1, F.lit(False))).drop("_bucket", "_bits")


def key_bits(keys: DataFrame, column: str) -> np.ndarray:
    """The same for a column that is a hash already, as bits at its remainders, to hand to
    Python tasks: `FILTER_BITS` bits, whatever the number of keys."""
    place = F.pmod(F.col(column), F.lit(FILTER_BITS)) + 1
    bitmap = keys.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit")).groupBy(
        "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in bitmap.toLocalIterator():
        part = np.frombuffer(row.bits, np.uint8)
        out[(row.bucket - 1) * len(part):][:len(part)] = part
    return out


def among_bits(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether each unsigned hash may be one of the keys."""
    place = (hashes & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def tiled(rows: DataFrame, keys: list[str], spread: Column, tile: int, name: str) -> DataFrame:
    """Cut the groups of `keys` into tiles of about `tile` rows and deal out pairs of tiles.

    Groups of one row are left out. A group that fits one tile is dealt once (`ti` = `tj`); any
    other gives each pair of its tiles, `ti` < `tj`, so that every two rows meet in some task
    that holds about two tiles. `tile` is a row's own tile, of `tiles`. `spread` is a hash that
    tells the rows apart.
    """
    sizes = written_table(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                          .where("_n > 1"), name)
    tiles = F.ceil(F.col("_n") / tile).cast("int")
    own = rows.join(sizes, keys).withColumn("_t", tiles).withColumn(
        "_i", F.pmod(spread, F.col("_t")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("_t") - 1),
                      lambda j: (F.col("_t") == 1) | (j != F.col("_i")))
    dealt = own.withColumn("_j", F.explode(others))
    return dealt.select(*rows.columns, F.least("_i", "_j").alias("ti"),
                        F.greatest("_i", "_j").alias("tj"), F.col("_i").alias("tile"),
                        F.col("_t").alias("tiles"))


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int = 1 << 16,
            ) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From rows sorted by `keys`: tables of whole groups, of about `limit` rows, with the place
    where each group starts. A group is never cut."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= limit:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = _starts(table, keys)
            cut = int(starts[-1])
            if cut:
                yield table.slice(0, cut), starts[:-1]
            rest = table.slice(cut)
            held, count = rest.to_batches(), (rest.num_rows if cut else 0)
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _starts(table, keys)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def whole_row(docs: DataFrame) -> Column:
    """All columns in one struct, so that no generated name can clash with one of theirs."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns))


def free_name(docs: DataFrame, name: str) -> str:
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def keep_rows(docs: DataFrame, id_column: str, text: str, marked: DataFrame, keys_of) -> DataFrame:
    """The rows of `docs` that `marked` (_id, _key, _kept; one row per document) keeps.

    Ids that one row has are decided by id alone, and only rows whose id may be among those not
    simply kept are shuffled. For ids of several rows and for null ids `keys_of` computes the key
    of each row (`_row`, `_text`) again, and one row of each kept (id, key) stays. Columns of `docs`
    may have any names.
    """
    ids = marked.groupBy("_id").agg(F.count(F.lit(1)).alias("_n"), F.max("_kept").alias("_any"))
    alone = (F.col("_n") == 1) & F.col("_id").isNotNull()
    others = written_table(ids.where(~alone | ~F.col("_any")), "other-ids")
    rows = docs.select(whole_row(docs).alias("_doc"), F.col(f"`{id_column}`").alias("_own_id")).where("_own_id is not null")
    named = others.where("_id is not null").select("_id")
    known = in_filter(rows, "_own_id", key_filter(named, "_id"))
    single = known.where("not _maybe").select("_doc").union(
        known.where("_maybe").join(named, F.col("_own_id") == F.col("_id"), "left_anti").select("_doc")).select("_doc.*")
    repeated = others.where(~alone & F.col("_any"))
    if repeated.isEmpty():
        return single
    same_id = F.col("_own_id").eqNullSafe(F.col("_id"))
    rest = docs.select(whole_row(docs).alias("_row"), F.col(f"`{id_column}`").alias("_own_id"),
                       F.col(f"`{text}`").alias("_text")).join(repeated, same_id, "left_semi")
    one = keys_of(rest).toDF("_row", "_own").groupBy(F.col("_row").getField(id_column).alias("_own_id"), "_own").agg(
        F.min("_row").alias("_row"))
    kept = marked.where("_kept").select("_id", "_key").distinct()
    one = one.join(kept, same_id & (F.col("_own") == F.col("_key")), "left_semi")
    return single.union(one.select("_row.*"))
