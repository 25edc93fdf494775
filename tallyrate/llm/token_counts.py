"""Token counts of whole texts: lengths only, in Arrow batches balanced by bytes.

Texts are cut at safe places (see `tokens`); each batch of about `BATCH_BYTES` goes to the
tokenizer library as one list of the pieces it has not seen, so a long text is encoded in small
parts and a batch never holds more than its share of bytes. Only lengths leave the workers and
nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrate.llm import common, tokens

BATCH_BYTES = 2 << 20
# Pieces of one text that are counted at once.
SPAN = 100_000


def count_batch(path: str, texts: list[str | None]) -> list[int]:
    """Number of tokens of each text; null has none."""
    cache = tokens.length_cache(path)
    cut = [tokens.pieces(text) if text else [""] for text in texts]
    lengths = [cache.of_first(found[0]) if found[0] else 0 for found in cut]
    ends = np.cumsum([0, *(len(found) - 1 for found in cut)])
    spaced = [piece for found in cut for piece in found[1:]]
    sums = np.zeros(len(spaced) + 1, np.int64)
    for at in range(0, len(spaced), SPAN):
        part = cache.of_spaced(spaced[at:at + SPAN])
        sums[at + 1:at + 1 + len(part)] = part
    np.cumsum(sums, out=sums)
    return (sums[ends[1:]] - sums[ends[:-1]] + np.array(lengths, np.int64)).tolist()


def count(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens as the tokenizer's own library gives
    them without added special tokens; null counts as empty. Repeated rows each have their row.
    Other columns of `docs` are not read."""
    rows = common.columns_of(docs, id=id_column, text=text)
    schema = T.StructType([rows.schema["id"], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.byte_sized(batches, "text", BATCH_BYTES):
            sizes = pc.binary_length(batch.column("text")).fill_null(0).cast(pa.int64())
            lengths = count_batch(path, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), sizes, pa.array(lengths, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])

    return common.map_batches(rows, of_batches, schema).withColumnRenamed("id", id_column)


def with_limit(counts: DataFrame, limit: int) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
