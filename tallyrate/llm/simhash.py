"""Near-duplicate documents by SimHash, found with covering locality-sensitive hashing.

A document's fingerprint has one bit per hash bit, 1 where over half its word shingles hash to
1. Fingerprints within `radius` bits are linked. The search keeps, for each mask of a covering
family, the fingerprint bits under the mask: any two fingerprints within the radius agree under
at least one mask, so no link is missed. Equal fingerprints are one node, buckets are compared
in bounded tiles, and a tile gives a spanning forest of its links rather than all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrate.llm import common
from tallyrate.storage import written_table

SEED = 42
BITS = 64

# Rows of a bucket compared at once in one task.
TILE = 2048


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks such that any `radius` bit places are all absent from one of them.

    Place i carries a nonzero vector p(i) of radius+1 bits. Mask v holds the places with odd
    <p(i), v>. The vectors of `radius` places span less than the whole space, so some nonzero v
    is orthogonal to all of them.
    """
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if ((i % vectors + 1) & v).bit_count() % 2)
            for v in range(1, vectors + 1)]


def fingerprint(text: str | None, shingle: int) -> int:
    """The unsigned fingerprint of a whole text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII spaces
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total = len(words) - shingle + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, total, 1 << 15):
        stop = min(total, at + (1 << 15))
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(
            starts[at:stop].tolist(), ends[at + shingle - 1:stop + shingle - 1].tolist())], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every row, as a signed long. Null texts count as empty."""
    rows = common.columns_of(docs, id=id_column, text=text)
    schema = T.StructType([rows.schema["id"], T.StructField("fp", T.LongType())])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()],
                             np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found.view(np.int64))], ["id", "fp"])

    return common.map_batches(rows, of_batches, schema)


def forest_of(values: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links, as two arrays of values, among the values of each group."""
    sizes = np.diff(np.append(starts, len(values)))
    left_after = np.repeat(sizes, sizes) - (np.arange(len(values)) - np.repeat(starts, sizes)) - 1
    label = np.arange(len(values))
    first, second = [], []
    active, step = np.flatnonzero(left_after > 0), 1
    while len(active):
        near = np.bitwise_count(values[active] ^ values[active + step]) <= radius
        for i in active[near].tolist():
            keep, gone = label[i], label[i + step]
            if keep != gone:
                first.append(i)
                second.append(i + step)
                group = starts[np.searchsorted(starts, i, side="right") - 1]
                span = label[group:group + sizes[np.searchsorted(starts, i, side="right") - 1]]
                span[span == gone] = keep
        step += 1
        active = active[left_after[active] >= step]
    return values[first], values[second]


def links(prints: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """(a, b): links between the distinct values of column `fp` that connect exactly the
    fingerprints within `radius` bits of each other, directly or by a chain."""
    masks = F.array(*(F.struct(F.lit(i).alias("t"), F.lit(_signed(m)).alias("m"))
                      for i, m in enumerate(covering_masks(radius))))
    keyed = prints.select("fp", F.explode(masks).alias("x")).select(
        "fp", F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.m")).alias("key"))
    dealt = common.tiled(keyed, ["t", "key"], F.xxhash64("fp"), tile, "bucket-sizes")
    keys = ["t", "key", "ti", "tj"]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in common.grouped(batches, keys):
            values = table.column("fp").to_numpy().view(np.uint64)
            a, b = forest_of(values, starts, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                             ["a", "b"])

    return common.map_batches(dealt.repartition(*keys).sortWithinPartitions(*keys, "fp"),
                              of_batches, "a long, b long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                    shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: id, `fp`, and `component_id`, the least id that links reach.

    Repeated rows are equal fingerprints, hence linked. Null texts, empty texts and texts of
    white space share fingerprint 0 and are linked like any other. A null id is never the least
    unless all ids of a component are null. Other columns of `docs` are not read.
    """
    prints = written_table(fingerprints(docs, id_column, text, shingle), "fingerprints")
    distinct = written_table(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fps")
    groups = written_table(common.components(links(distinct, radius)), "fp-components")
    named = distinct.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    named = written_table(named, "named-fps")
    lowest = written_table(named.groupBy("component").agg(F.min("least").alias("component_id")),
                           "component-ids")
    by_print = written_table(named.join(lowest, "component").select("fp", "component_id"),
                             "fp-ids")
    return prints.join(by_print, "fp").select(F.col("id").alias(id_column), "fp", "component_id")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 3,
             radius: int = 3) -> DataFrame:
    """The row with the least id of each component, all columns. Of rows that share that id one
    stays; a component without any id keeps one row."""
    found = near_duplicates(docs, id_column, text, shingle, radius)
    return common.keep_rows(docs, id_column, text, found.select(
        F.col(id_column).alias("_id"), F.col("fp").alias("_key"),
        F.col(id_column).eqNullSafe(F.col("component_id")).alias("_kept")),
        lambda rows: fingerprints(rows, "_row", "_text", shingle))
