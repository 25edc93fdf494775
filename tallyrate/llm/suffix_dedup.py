"""Removal of repeated byte strings, found with suffix arrays over shards of the text.

Every window of `length` bytes belongs to one anchor: the least hash among the substrings of
`GRAM` bytes inside it. Equal windows have equal anchors, so only stretches of windows whose
anchor occurs again can repeat. Equal stretches are one; the different ones of an anchor meet in
a shard, where an array of their suffixes is built by induced sorting and the permuted common
prefixes show which windows occur twice. An anchor with more stretches than a shard should hold
is decided window by window, by grouping digests; both ways give the same answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrate.llm import common, suffix_array
from tallyrate.llm.bpe import _SPAN, rolling
from tallyrate.storage import written_table

LENGTH = 200
# Different stretches of one anchor that are sorted in one shard, and bytes of a shard's text.
STRETCHES = 4096
SHARD_BYTES = 1 << 20


def window_anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of at most `_SPAN` bytes: its anchor's place and hash."""
    gram = length // 2
    width = length - gram + 1
    hashes = rolling(data, gram)
    low = np.uint64((1 << 21) - 1)
    # Among equal hashes the last place counts: it depends on the window's content only.
    marked = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    n = len(hashes) - width + 1
    rows = -(-len(marked) // width)
    block = np.full(rows * width, ~np.uint64(0))
    block[:len(marked)] = marked
    block = block.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[width - 1:width - 1 + n])
    places = (low - (least & low)).astype(np.int64)
    return places, hashes[places]


def stretches(data: np.ndarray, ends: np.ndarray, length: int,
              ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first window, number of windows, anchor hash) of all stretches of windows with one
    anchor, in texts that lie one after the other and end at `ends`; none crosses an end."""
    step = _SPAN - length + 1
    for at in range(0, max(0, len(data) - length + 1), step):
        part = data[at:at + _SPAN]
        if len(part) < length:
            break
        places, hashes = window_anchors(part, length)
        starts = np.arange(len(places)) + at
        stop = ends[np.searchsorted(ends, starts, side="right")]
        inside = starts + length <= stop
        new = np.append(True, (places[1:] != places[:-1]) | (stop[1:] != stop[:-1])) & inside
        first = np.flatnonzero(new)
        if len(first) == 0:
            continue
        # A stretch ends before the next one, or where windows would cross the end of its text.
        last = np.minimum(np.append(starts[first[1:]], at + len(places)), stop[first] - length + 1)
        yield starts[first], last - starts[first], hashes[first]


def _bytes_of(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in a row, and where each value ends."""
    values = batch.column(column)
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1]
    buffer = values.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], (offsets[1:] - offsets[0]).astype(np.int64)


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.byte_sized(batches, "text", _SPAN):
            for _, _, hashes in stretches(*_bytes_of(batch, "text"), length):
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["anchor"])
    return common.map_batches(rows.select("text"), of_batches, "anchor long")


def _candidates(rows: DataFrame, length: int, bits: np.ndarray) -> DataFrame:
    """(key, start, n, anchor, digest) of the stretches whose anchor may be among `bits`; start counts
    from the text's start."""
    schema = pa.schema([("key", pa.binary()), ("start", pa.int64()), ("n", pa.int32()),
                        ("anchor", pa.int64()), ("digest", pa.binary())])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.byte_sized(batches, "text", _SPAN):
            data, ends = _bytes_of(batch, "text")
            begins = np.append(0, ends[:-1])
            whole, keys = data.tobytes(), batch.column("key")
            for starts, counts, hashes in stretches(data, ends, length):
                maybe = common.among_bits(hashes, bits)
                starts, counts, hashes = starts[maybe], counts[maybe], hashes[maybe]
                text = np.searchsorted(ends, starts, side="right")
                digests = [blake2b(whole[s:e], digest_size=16).digest() for s, e in zip(
                    starts.tolist(), (starts + counts + length - 1).tolist())]
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array(text)), pa.array(starts - begins[text]),
                    pa.array(counts.astype(np.int32)), pa.array(hashes.view(np.int64)),
                    pa.array(digests, pa.binary())], schema=schema)
    return common.map_batches(rows.select("key", "text"), of_batches,
                              "key binary, start long, n int, anchor long, digest binary")


def _may_repeat(texts: list[bytes], length: int) -> np.ndarray:
    """Which of the texts have a window whose hash the list holds twice. Equal windows have equal
    hashes, so no other text has a window that occurs again."""
    sizes = np.array([len(t) for t in texts])
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes)
    hashes = np.concatenate([rolling(data[at:at + _SPAN], length) for at in range(0, len(data) - length + 1, _SPAN - length + 1)])
    owner = np.repeat(np.arange(len(texts)), sizes)[:len(hashes)]
    inside = np.flatnonzero(np.arange(len(hashes)) + length <= ends[owner])
    order = inside[np.argsort(hashes[inside], kind="stable")]
    twice = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    found = np.zeros(len(texts), bool)
    found[owner[order[twice]]] = True
    found[owner[order[twice + 1]]] = True
    return found


def repeated_windows(stretch_texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each of the different texts: which of its windows occur again in the list. Texts that
    cannot have any are left out of the array."""
    kept = np.flatnonzero(_may_repeat(stretch_texts, length)).tolist()
    found = [np.zeros(len(t) - length + 1, bool) for t in stretch_texts]
    if kept:
        for at, windows in zip(kept, _judged([stretch_texts[i] for i in kept], length), strict=True):
            found[at] = windows
    return found


def _judged(stretch_texts: list[bytes], length: int) -> list[np.ndarray]:
    """The same of all texts, by their suffix array."""
    sizes = np.array([len(t) for t in stretch_texts])
    starts = np.cumsum(np.append(0, sizes[:-1] + 1))
    joined = np.frombuffer(b"\0".join(stretch_texts), np.uint8).astype(np.int64) + 1
    joined[starts[1:] - 1] = 0  # no byte is 0 now, so prefixes that count never pass a text's end
    order = suffix_array.suffix_array(joined)
    prefixes = suffix_array.permuted_prefixes(joined, order, length)
    in_text = np.repeat(starts, sizes + 1)[:len(joined)]
    room = np.repeat(sizes, sizes + 1)[:len(joined)] - (np.arange(len(joined)) - in_text)
    with_earlier = (prefixes[order] >= length) & (room[order] >= length)
    repeated = np.zeros(len(joined), bool)
    repeated[order[with_earlier]] = True
    repeated[order[:-1][with_earlier[1:]]] = True
    return [repeated[s:s + n - length + 1] for s, n in zip(starts.tolist(), sizes.tolist())]


def _intervals(found: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true values."""
    edges = np.diff(np.concatenate(([0], found.astype(np.int8), [0])))
    return list(zip(np.flatnonzero(edges == 1).tolist(), (np.flatnonzero(edges == -1) - 1).tolist()))


def _in_shards(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, digest, lo, hi): repeated windows of stretches that share an anchor."""
    schema = pa.schema([("anchor", pa.int64()), ("digest", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32())])

    def result(held: dict[tuple[int, bytes], bytes]) -> pa.RecordBatch:
        rows = [(*key, lo, hi) for key, found in zip(held, repeated_windows(list(held.values()), length))
                for lo, hi in _intervals(found)]
        return common.batch_of(schema, *(zip(*rows) if rows else ([], [], [], [])))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], bytes] = {}
        size, last = 0, None
        for batch in batches:
            for anchor, digest, text in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "stretch"))):
                if anchor != last and size >= SHARD_BYTES:
                    yield result(held)
                    held, size = {}, 0
                last = anchor
                if (anchor, digest) not in held:  # rows that repeat id and text send a stretch twice
                    held[anchor, digest] = text
                    size += len(text)
        if held:
            yield result(held)

    return common.map_batches(texts.select("anchor", "digest", "stretch").repartition("anchor")
                              .sortWithinPartitions("anchor", "digest"), of_batches,
                              "anchor long, digest binary, lo int, hi int")


def _by_windows(texts: DataFrame, length: int) -> DataFrame:
    """The same, by a digest of each window."""
    schema = pa.schema([("anchor", pa.int64()), ("digest", pa.binary()), ("at", pa.int32()), ("window", pa.binary())])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, digest, text in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "stretch"))):
                n = len(text) - length + 1
                yield common.batch_of(schema, [anchor] * n, [digest] * n, range(n), [
                    blake2b(text[i:i + length], digest_size=16).digest() for i in range(n)])

    windows = common.map_batches(texts, of_batches, "anchor long, digest binary, at int, window binary")
    windows = written_table(windows.distinct(), "windows")
    again = written_table(windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-windows")
    return windows.join(again, "window", "left_semi").select(
        "anchor", "digest", F.col("at").alias("lo"), F.col("at").alias("hi"))


def repeated(docs: DataFrame, id_column: str, text: str, length: int, most: int) -> tuple[DataFrame, DataFrame]:
    """The documents as (id, text as bytes, key), and (key, found) with the windows of each
    text, as (lo, hi) of their starts, that occur elsewhere."""
    rows = common.columns_of(docs, id=id_column, text=text).select(
        "id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    rows = rows.withColumn("key", F.unhex(F.md5("text")))
    again = written_table(_anchors(rows, length).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
                          .where("n > 1").select("anchor"), "repeated-anchors")
    found = _candidates(rows, length, common.key_bits(again, "anchor"))
    # Copies of a text have the same stretches: they are merged here, and counted.
    found = written_table(found.groupBy("anchor", "digest", "key", "start", "n").agg(
        F.count(F.lit(1)).alias("copies")), "stretches")
    kinds = written_table(found.groupBy("anchor", "digest").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("key", "start", "n")).alias("one")), "stretch-kinds")
    several = written_table(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "shared-anchors")
    compared = kinds.join(several, "anchor").select(
        "anchor", "digest", "kinds", F.col("one.key").alias("key"), F.col("one.start").alias("start"), F.col("one.n").alias("n"))
    places = compared.groupBy("key").agg(F.collect_list(F.struct("anchor", "digest", "kinds", "start", "n")).alias("places"))
    first = rows.groupBy("key").agg(F.min("id").alias("first"))
    places = written_table(places.join(first, "key").withColumn("row", F.xxhash64("key", "first")), "stretch-places")
    holders = common.in_filter(rows.withColumn("row", F.xxhash64("key", "id")), "row", common.key_filter(places, "row"))
    holders = holders.where("_maybe").select("row", "key", "text").join(
        places.select("row", F.col("key").alias("_key"), "places"), "row").where("key = _key")
    cut = holders.select("text", F.explode("places").alias("p")).select(
        "p.anchor", "p.digest", "p.kinds", F.substring("text", F.col("p.start").cast("int") + 1, F.col("p.n") + length - 1).alias("stretch"))
    cut = written_table(cut, "stretch-texts")
    windows = written_table(
        kinds.where("copies > 1").select("anchor", "digest", F.lit(0).alias("lo"), (F.col("one.n") - 1).alias("hi"))
        .union(_in_shards(cut.where(F.col("kinds") <= most), length))
        .union(_by_windows(cut.where(F.col("kinds") > most).select("anchor", "digest", "stretch"), length)),
        "repeated-stretches")
    spans = found.join(windows, ["anchor", "digest"]).select(
        "key", F.struct((F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi")).alias("x"))
    return rows, written_table(spans.groupBy("key").agg(F.collect_set("x").alias("found")), "repeated-spans")


def removed_spans(found: list | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes, as (start, end), that the windows cover."""
    out: list[tuple[int, int]] = []
    for window in sorted((x["lo"], x["hi"]) for x in found or ()):
        start, end = window[0], window[1] + length
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                   length: int = LENGTH, most: int = STRETCHES) -> DataFrame:
    """One row per document: id, n_bytes, `spans` (start, end of each removed run of bytes) and
    `kept` (the remaining bytes, which may cut a character).

    A byte goes if a string of `length` bytes that covers it also starts anywhere else, in any
    row. A null text counts as empty. Rows that repeat another, id included, are documents of
    their own and lose what they share. Other columns of `docs` are not read.
    """
    rows, spans = repeated(docs, id_column, text, length, most)
    keyed = rows.withColumn("row", F.xxhash64("key"))
    known = common.in_filter(keyed, "row", common.key_filter(spans.withColumn("row", F.xxhash64("key")), "row"))
    none = F.lit(None).cast(spans.schema["found"].dataType)
    both = known.where("not _maybe").select("id", "text", none.alias("found")).union(
        known.where("_maybe").select("id", "text", "key").join(spans, "key", "left").select("id", "text", "found"))
    schema = T.StructType([
        rows.schema["id"], T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.BinaryType())])
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.byte_sized(batches, "text"):
            sizes, gone, kept = [], [], []
            for data, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
                own = removed_spans(found, length)
                ends = [0, *(e for _, e in own)]
                sizes.append(len(data))
                gone.append([{"start": s, "end": e} for s, e in own])
                kept.append(b"".join([data[e:s] for e, (s, _) in zip(ends, own)] + [data[ends[-1]:]]))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(sizes, pa.int64()), pa.array(gone, span_type),
                pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    return common.map_batches(both, of_batches, schema).withColumnRenamed("id", id_column)
