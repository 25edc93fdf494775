"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash cuts each text where its last bytes say so, so equal passages of different
documents are cut alike. Chunks that several documents share are encoded once, by the document
that owns them, and handed to the others. Where chunks meet, the text from the last safe cut of
the left chunk to the first safe cut of the right one is encoded again; a window without a safe
cut grows over the next chunk. Outside the windows both encodings agree token by token.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrate.llm import common, tokens
from tallyrate.storage import written_table

# Bytes that a cut depends on, mean chunk length as a power of two, least and greatest length.
WINDOW, MEAN_BITS, LEAST, MOST = 48, 10, 256, 8192

# Bytes of text whose ids and decoded texts a worker holds.
BATCH_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPAN = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _SPAN), _powers(_INVERSE, _SPAN)


def rolling(data: np.ndarray, window: int) -> np.ndarray:
    """Hash of each run of `window` bytes, by its start, for at most `_SPAN` bytes; the high bits
    are the well-mixed ones."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:len(data)], out=sums[1:])
    hashes = (sums[window:] - sums[:-window]) * _DOWN[:len(data) - window + 1]
    hashes ^= hashes >> np.uint64(29)
    return hashes * np.uint64(0xBF58476D1CE4E5B9)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a UTF-8 text. Characters stay whole."""
    if len(data) <= LEAST:
        return [len(data)] if data else []
    raw = np.frombuffer(data, np.uint8)
    found = []
    step = _SPAN - WINDOW
    for at in range(0, max(1, len(raw) - WINDOW + 1), step):
        part = raw[at:at + _SPAN]
        if len(part) >= WINDOW:
            hits = np.flatnonzero(rolling(part, WINDOW)[:step] >> np.uint64(64 - MEAN_BITS) == 0)
            found.append(hits + at + WINDOW)
    places = np.concatenate(found) if found else np.zeros(0, np.int64)
    places = places[places < len(raw)]
    places = places[(raw[places] & 0xC0) != 0x80]
    ends, last = [], 0
    for place in [*places.tolist(), len(data)]:
        while place - last > MOST:
            cut = last + MOST
            while data[cut] & 0xC0 == 0x80:
                cut -= 1
            ends.append(cut)
            last = cut
        if place - last >= LEAST or place == len(data) > last:
            ends.append(place)
            last = place
    return ends


def chunks(data: bytes) -> list[tuple[bytes, bytes]]:
    """Digest and bytes of each chunk."""
    start, out = 0, []
    for end in cuts(data):
        part = data[start:end]
        out.append((blake2b(part, digest_size=16).digest(), part))
        start = end
    return out


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8")


def chunk_parts(path: str, chunk: str) -> tuple[str, bytes, str | None]:
    """Text up to the first safe cut, ids up to the last one, text behind it. A chunk without a
    safe cut is all head and has no tail."""
    found = tokens.pieces(chunk)
    if len(found) == 1:
        return chunk, b"", None
    middle = b"".join(tokens.id_cache(path).of_spaced(found[1:-1]))
    return found[0], middle, " " + found[-1]


def encode_text(path: str, text: str) -> bytes:
    cache = tokens.id_cache(path)
    found = tokens.pieces(text)
    first = cache.of_first(found[0]) if found[0] else b""
    return first + b"".join(cache.of_spaced(found[1:])) if len(found) > 1 else first


def encode_with(path: str, text: str, shared: dict[bytes, tuple[str, bytes, str | None]]) -> bytes:
    """Ids of the text, from the shared chunks it has and by encoding what lies between them."""
    if not shared:
        return encode_text(path, text)
    out, window = [], ""
    for digest, part in chunks(_utf8(text)):
        known = shared.get(digest)
        if known is None or known[2] is None:
            window += part.decode("utf-8")
        else:
            head, middle, tail = known
            out += [encode_text(path, window + head), middle]
            window = tail
    return b"".join([*out, encode_text(path, window)])


def _occurrences(rows: DataFrame) -> DataFrame:
    """(chunk, key): the distinct chunks of each document."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release_memory()
        schema = pa.schema([("chunk", pa.binary()), ("key", pa.int64())])
        for batch in common.byte_sized(batches, "text"):
            found, keys = [], []
            for key, text in dict(zip(batch.column("key").to_pylist(), batch.column("text").to_pylist())).items():
                own = {digest for digest, _ in chunks(_utf8(text))}
                found += own
                keys += [key] * len(own)
            yield common.batch_of(schema, found, keys)
    return common.map_batches(rows.select("key", "text"), of_batches, "chunk binary, key long")


def _shared_parts(rows: DataFrame, shared: DataFrame, path: str) -> DataFrame:
    """(chunk, head, ids, tail) of each shared chunk, from the text of its owner."""
    owned = shared.groupBy(F.col("owner").alias("key")).agg(F.collect_set("chunk").alias("owned"))
    owned = written_table(owned, "owned-chunks")
    texts = common.in_filter(rows, "key", common.key_filter(owned, "key")).where("_maybe").select(
        "key", "text").join(owned, "key").select("text", "owned")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release_memory()
        schema = pa.schema([("chunk", pa.binary()), ("head", pa.string()), ("ids", pa.binary()),
                            ("tail", pa.string())])
        for batch in common.byte_sized(batches, "text"):
            found = []
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("owned").to_pylist()):
                own = dict(chunks(_utf8(text)))
                found += [(d, *chunk_parts(path, own[d].decode("utf-8"))) for d in wanted if d in own]
            if found:
                yield common.batch_of(schema, *zip(*found))
    parts = common.map_batches(texts, of_batches, "chunk binary, head string, ids binary, tail string")
    return parts.groupBy("chunk").agg(F.min(F.struct("head", "ids", "tail")).alias("part"))


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, `ids` (array of int) and `decoded`, as the tokenizer's own
    library gives them without added special tokens.

    A null text counts as empty and has no ids. Repeated rows each have their row; a text that a
    batch holds more than once is encoded once. Texts may be of any length. Rows are told apart by a hash of id and text; two that share it would only encode more by themselves.
    Other columns of `docs` are not read.
    """
    rows = common.columns_of(docs, id=id_column, text=text)
    rows = rows.select("id", "text", F.xxhash64("id", "text").alias("key"))
    seen = written_table(_occurrences(rows), "chunks")
    # Repeated rows have one key: a chunk is shared when different documents have it.
    shared = written_table(seen.groupBy("chunk").agg(F.min("key").alias("owner"), F.max("key").alias("other"))
                           .where("owner < other").drop("other"), "shared-chunks")
    parts = written_table(_shared_parts(rows, shared, path), "encoded-chunks")
    # Both sides are plain scans, so a chunk that many documents share can be split.
    users = written_table(seen.join(parts, "chunk"), "chunk-users")
    lists = written_table(users.groupBy("key").agg(
        F.collect_set(F.struct("chunk", "part")).alias("parts")), "document-chunks")
    known = common.in_filter(rows, "key", common.key_filter(lists, "key"))
    none = F.lit(None).cast(lists.schema["parts"].dataType)
    alone = known.where("not _maybe").select("id", "text", none.alias("parts"))
    joined = known.where("_maybe").select("id", "text", "key").join(lists, "key", "left").select(
        "id", "text", "parts")
    schema = T.StructType([rows.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release_memory()
        for batch in common.byte_sized(batches, "text", BATCH_BYTES):
            encoded, decoded, done = [], [], {}
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts")):
                if text not in done:
                    own = {x["chunk"]: (x["part"]["head"], x["part"]["ids"], x["part"]["tail"])
                           for x in parts.as_py() or ()}
                    ids = encode_with(path, text or "", own)
                    done[text] = ids, tokens.decode(path, np.frombuffer(ids, "<i4").tolist())
                encoded.append(done[text][0])
                decoded.append(done[text][1])
            ids = np.frombuffer(b"".join(encoded), "<i4")
            ends = np.cumsum([0, *(len(x) // 4 for x in encoded)])
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                pa.array(decoded, pa.string())], names=["id", "ids", "decoded"])

    out = common.map_batches(alone.union(joined), of_batches, schema)
    return out.withColumnRenamed("id", id_column)
