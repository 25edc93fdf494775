"""Exact duplicates through a sharded index of cuckoo filters.

The index is a table: one row per live digest with its shard, its slot in the shard's cuckoo
filter and what is stored for it (the id that stays and the number of rows). A batch of inserts
or deletions is grouped by shard; a task rebuilds its shard's filter from the stored slots,
probes it for each digest, and verifies every hit against the full digest stored in that slot.
A shard holds a bounded number of rows; their number grows with the index.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrate.llm import common
from tallyrate.storage import written_table

# Digests of a shard, at most about; and the least number of shards, a power of two.
SHARD_ROWS = 200_000
SHARDS = 512
# A batch's copies of one digest are merged to at most this many rows before they are shuffled.
SALTS = 16
KICKS = 500
SLOTS = 4

# A run of white space that is not one space already.
_UNEVEN = "[\\x09-\\x0D][\\x20\\x09-\\x0D]*|\\x20[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _UNEVEN, " ")


def digests(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest): SHA-256 of each row's normalised whole text."""
    rows = common.columns_of(docs, id=id_column, text=text)
    return rows.select("id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"))


class CuckooFilter:
    """A cuckoo filter whose slots point at the stored keys, so that hits can be verified and a
    full filter can be built anew, twice as large, from the keys themselves."""

    def __init__(self, buckets: int = 16):
        self.keys: list[bytes | None] = []
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.buckets = buckets
        self.prints = [0] * (buckets * SLOTS)
        self.owners = [-1] * (buckets * SLOTS)

    @staticmethod
    def _print_of(key: bytes) -> int:
        return int.from_bytes(key[12:14], "little") or 1

    def _first(self, key: bytes) -> int:
        return int.from_bytes(key[8:12], "little") & (self.buckets - 1)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995 >> 8) & (self.buckets - 1))

    def slot_of(self, key: bytes) -> int:
        """The slot that holds `key`, verified; -1 if it is not live."""
        mark, bucket = self._print_of(key), self._first(key)
        for start in (bucket * SLOTS, self._other(bucket, mark) * SLOTS):
            for slot in range(start, start + SLOTS):
                if self.prints[slot] == mark and self.keys[self.owners[slot]] == key:
                    return slot
        return -1

    def find(self, key: bytes) -> int:
        """Number of the stored key, or -1."""
        slot = self.slot_of(key)
        return self.owners[slot] if slot >= 0 else -1

    def insert(self, key: bytes) -> int:
        """Store a key that is not live; returns its number."""
        self.keys.append(key)
        number = len(self.keys) - 1
        if not self._place(number):
            self.resize(self.buckets * 2)
        return number

    def restore(self, key: bytes, slot: int) -> int:
        """Store a key at the slot where it was before."""
        self.keys.append(key)
        self.prints[slot], self.owners[slot] = self._print_of(key), len(self.keys) - 1
        return len(self.keys) - 1

    def delete(self, key: bytes) -> bool:
        slot = self.slot_of(key)
        if slot < 0:
            return False
        self.keys[self.owners[slot]] = None
        self.prints[slot], self.owners[slot] = 0, -1
        return True

    def resize(self, buckets: int) -> None:
        """Place all stored keys in an empty filter of that many buckets, or more."""
        while True:
            self._empty(buckets)
            if all(self._place(n) for n, key in enumerate(self.keys) if key is not None):
                return
            buckets *= 2

    def _place(self, number: int) -> bool:
        mark, bucket = self._print_of(self.keys[number]), self._first(self.keys[number])
        for turn in range(KICKS):
            start = bucket * SLOTS
            for slot in range(start, start + SLOTS):
                if self.prints[slot] == 0:
                    self.prints[slot], self.owners[slot] = mark, number
                    return True
            if turn:  # both places are full: take a slot and move what was there
                slot = start + (turn + mark) % SLOTS
                self.prints[slot], mark = mark, self.prints[slot]
                self.owners[slot], number = number, self.owners[slot]
            bucket = self._other(bucket, mark)
        return False


_STORED, _INSERT, _DELETE = 0, 1, 2


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("buckets", T.IntegerType()),
        T.StructField("slot", T.IntegerType()), T.StructField("digest", T.BinaryType()),
        T.StructField("keep_id", id_type), T.StructField("n", T.LongType())])


def _apply(rows: pa.Table) -> pa.Table:
    """One shard: its stored rows, then its batch."""
    rows = rows.sort_by("kind")
    kinds, keys = rows.column("kind").to_pylist(), rows.column("digest").to_pylist()
    slots, sizes = rows.column("slot").to_pylist(), rows.column("buckets").to_pylist()
    ids, counts = rows.column("keep_id").to_pylist(), rows.column("n").to_pylist()
    stored = kinds.count(_STORED)
    found = CuckooFilter(max(16, sizes[0] or 0) if stored else 16)
    least: list = []
    total: list[int] = []
    kept_place = stored and all(slot is not None for slot in slots[:stored])
    for at in range(stored):
        if kept_place:
            found.restore(keys[at], slots[at])
        else:
            found.insert(keys[at])
        least.append(ids[at])
        total.append(counts[at])
    for at in range(stored, len(keys)):
        number = found.find(keys[at])
        if kinds[at] == _DELETE:
            if number >= 0:
                found.delete(keys[at])
        elif number < 0:
            found.insert(keys[at])
            least.append(ids[at])
            total.append(counts[at])
        else:
            total[number] += counts[at]
            if least[number] is None or (ids[at] is not None and ids[at] < least[number]):
                least[number] = ids[at]
    live = [(slot, number) for slot, number in enumerate(found.owners) if number >= 0]
    shard = rows.column("shard")[0].as_py()
    numbers = [number for _, number in live]
    return pa.table({
        "shard": pa.array([shard] * len(live), pa.int32()),
        "buckets": pa.array([found.buckets] * len(live), pa.int32()),
        "slot": pa.array([slot for slot, _ in live], pa.int32()),
        "digest": pa.array([found.keys[n] for n in numbers], pa.binary()),
        "keep_id": pa.array([least[n] for n in numbers], rows.schema.field("keep_id").type),
        "n": pa.array([total[n] for n in numbers], pa.int64())})


@dataclass(frozen=True)
class ExactIndex:
    """Live digests; each change returns a new index over a newly written table."""

    table: DataFrame | None = None
    shards: int = 0

    def insert(self, rows: DataFrame) -> ExactIndex:
        """Add (id, digest) rows. Of equal digests the least id stays; null ids count as rows."""
        merged = rows.groupBy("digest", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt")).agg(
            F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        batch = merged.select(F.lit(_INSERT).alias("kind"), "digest", "keep_id", "n")
        return self._changed(batch, rows.count(), rows.schema["id"].dataType)

    def delete(self, rows: DataFrame) -> ExactIndex:
        """Remove the digests of column `digest`; unknown ones change nothing."""
        if self.table is None:
            return self
        kind = self.table.schema["keep_id"].dataType
        batch = rows.select("digest").distinct().select(
            F.lit(_DELETE).alias("kind"), "digest", F.lit(None).cast(kind).alias("keep_id"),
            F.lit(0).cast("long").alias("n"))
        return self._changed(batch, 0, kind)

    def _changed(self, batch: DataFrame, added: int, kind: T.DataType) -> ExactIndex:
        spark = batch.sparkSession
        common.ship_package(spark)
        shards, size = SHARDS, (self.table.count() if self.table else 0) + added
        while shards * SHARD_ROWS < size:
            shards *= 2
        same = shards == self.shards
        rows = batch.select("kind", "digest", "keep_id", "n", F.lit(None).cast("int").alias("slot"),
                            F.lit(None).cast("int").alias("buckets"))
        if self.table is not None:
            rows = self.table.select(
                F.lit(_STORED).alias("kind"), "digest", "keep_id", "n",
                (F.col("slot") if same else F.lit(None).cast("int")).alias("slot"),
                (F.col("buckets") if same else F.lit(None).cast("int")).alias("buckets"),
            ).union(rows)
        shard = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % shards
        after = rows.withColumn("shard", shard.cast("int")).groupBy("shard").applyInArrow(
            _apply, _schema(kind))
        return ExactIndex(written_table(after, "exact-index"), shards)

    def lookup(self, rows: DataFrame) -> DataFrame:
        """(id, digest) rows with `keep_id` and `n` of their digest, null if it is not live."""
        return rows.join(self.table.select("digest", "keep_id", "n"), "digest", "left")


def duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, digest.

    Texts are equal when their normalised forms are; null counts as empty, and all empty texts
    are one group. Rows that repeat an id and text count each, and all are marked kept if their
    id is; `keep_one` leaves one of them. A null id is never `keep_id` unless a group has no
    other. Other columns of `docs` are not read.
    """
    rows = written_table(digests(docs, id_column, text), "digests")
    found = ExactIndex().insert(rows).lookup(rows)
    return found.select(F.col("id").alias(id_column), "keep_id", F.col("n").alias("group_size"),
                        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the least id of each group of equal texts, all columns; of rows that share
    that id one stays."""
    found = duplicates(docs, id_column, text)
    return common.keep_rows(docs, id_column, text, found.select(
        F.col(id_column).alias("_id"), F.col("digest").alias("_key"), F.col("kept").alias("_kept")),
        lambda rows: digests(rows, "_row", "_text"))
