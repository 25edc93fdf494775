"""Alignment of the tokens of two tokenizers over the same bytes.

All tokens of both sides are sorted by their first byte; where a start reaches the greatest end
so far, no token spans and a new group begins. All tokens A of a group are linked with all its
tokens B. An id pair counts once for each document that holds it linked.

Texts are cut before safe spaces (a space between characters that are not white space), which no
token of either side spans; a worker aligns each different piece once and adds pieces up to
documents. Whether the two tokenizers allow it is read from their files (`safe_cuts`); otherwise
whole texts are aligned. Pairs are counted by grouping. For the lookup both the counted pairs
and the documents' pairs are dealt into fragments of about PAIRS different pairs, and the
documents' side of a fragment into parts of about LOOKUPS entries, so neither a frequent pair nor
the number of pairs bounds what a task holds.

Null and empty texts, and those which a tokenizer does not give back byte for byte, have no
tokens: zeros. Every row is a document, repeated ids and rows included. Only the named columns
are read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrate.llm import common, tokens
from tallyrate.storage import written_table

PAIRS, LOOKUPS = 1_000_000, 8_000_000
# What a worker keeps of aligned pieces, in characters.
HELD = 3_000_000
# Characters that go to a tokenizer at once, links that are expanded at once, documents whose
# pairs are dealt out at once.
JOINED, EXPANDED, DEALT = 1 << 18, 1 << 21, 512


def byte_level_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    stands for itself, the other bytes follow from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Side:
    """Ids and bytes of one tokenizer."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
                          for i, p in enumerate(pieces)]
            # It puts the space in front by itself.
            self.encode = lambda texts: [model.encode(text[1:], num_threads=1) for text in texts]
            self.safe = not any(a != "▁" and b == "▁" for p in pieces for a, b in zip(p, p[1:]))
        else:
            tokens.load(path)  # the library's threads off
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            model.encode_special_tokens = True
            byte = byte_level_alphabet()
            names = [model.id_to_token(i) or "" for i in range(model.get_vocab_size(with_added_tokens=True))]
            self.bytes = [bytes(byte[c] for c in p) if all(c in byte for c in p) else p.encode() for p in names]
            self.encode = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
            with open(path, encoding="utf-8") as file:
                found = json.load(file)
            cut = found["pre_tokenizer"] or {}
            self.safe = not found["normalizer"] and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def ids_of(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text, none where their bytes are not the text's."""
        found = self.encode(texts)
        return [np.array(ids, np.int64) if b"".join([self.bytes[i] for i in ids]) == text.encode() else None
                for text, ids in zip(texts, found)]


def pieces(text: str, cut: bool = True) -> list[str]:
    """The text cut before spaces that stand between characters other than white space; all
    pieces have lost the space in front, the first one never had it."""
    if not cut:
        return [text]
    found = tokens.pieces(text)
    if "  " not in text and "▁" not in text and found[0]:
        return found
    out = found[:1]
    for piece in found[1:]:
        if not out[-1] or out[-1][-1] in " ▁":
            out[-1] += " " + piece
        else:
            out.append(piece)
    return out


def _joins(piece: str) -> bool:
    """Whether the piece, with its space, may stand between others as it does in a text."""
    return bool(piece) and piece[-1] not in " ▁" and not tokens.starts_loose(piece)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, and the sum of each one's values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(values, first) if len(first) else values)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of these ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Aligned:
    """Alignments of pieces, by number: counts, group texts, and pairs with their times."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.span = len(a.bytes) * len(b.bytes)
        width = max(len(a.bytes), len(b.bytes))
        self.width = width
        self.names = [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(width)]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.texts: list[str | None] = []
        self.broken = False
        self.counts = np.zeros((0, 4), np.int64)  # tokens A, tokens B, groups, links
        self.ends = np.zeros(1, np.int64)
        self.codes, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def numbers(self, wanted: list[str]) -> np.ndarray:
        """The number of each piece; new ones are aligned first. `texts` is None for a piece
        whose bytes do not come back."""
        known = self.known
        found = [known.get(piece) for piece in wanted]
        if None in found:
            missing = sorted({p for p, n in zip(wanted, found) if n is None}, key=_joins, reverse=True)
            for piece in missing:
                known[piece] = len(known)
            self.held += sum(map(len, missing))
            self._add(missing)
            found = [known[piece] for piece in wanted]
        return np.array(found, np.int64)

    def _ids(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which pieces come back whole, their byte sizes, and the ids of both sides in a row."""
        whole, ids_a, ids_b = np.ones(len(new), bool), [], []
        joining = sum(map(_joins, new))
        ends = np.cumsum([len(p) + 1 for p in new])
        at = 0
        while at < len(new):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + JOINED, "right")))
            together = stop <= joining or at < joining
            stop = min(stop, joining) if together else stop
            alone = [" " + p for p in new[at:stop]]
            found = list(zip(*(side.ids_of(["".join(alone)] if together else alone) for side in (self.a, self.b))))
            if together and any(ids is None for ids in found[0]):
                found, together = list(zip(self.a.ids_of(alone), self.b.ids_of(alone))), False
            for i, (a, b) in enumerate(found):
                if a is not None and b is not None:
                    ids_a.append(a)
                    ids_b.append(b)
                else:
                    whole[at + i] = False
            at = stop
        sizes = np.array([len(p.encode()) + 1 for p in new], np.int64)
        none = [np.zeros(0, np.int64)]
        return whole, sizes, np.concatenate(ids_a + none), np.concatenate(ids_b + none)

    def _add(self, new: list[str]) -> None:
        whole, sizes, ids_a, ids_b = self._ids(new)
        places, ends = np.flatnonzero(whole), np.cumsum(sizes[whole])
        groups = coalesce(self.a.sizes[ids_a], self.b.sizes[ids_b])
        group_a, group_b, starts = groups
        n_a, n_b = np.bincount(group_a, minlength=len(starts)), np.bincount(group_b, minlength=len(starts))
        piece = np.searchsorted(ends, starts, "right")
        counts = np.zeros((len(new), 4), np.int64)
        for column, values in enumerate((n_a, n_b, np.ones(len(starts), np.int64), n_a * n_b)):
            np.add.at(counts[:, column], places[piece], values)
        codes, times = self._pairs(ids_a, ids_b, group_a, n_b, piece)
        texts: list[str | None] = [None] * len(new)
        for place, text in zip(places.tolist(), self._texts(ids_a, ids_b, group_a, group_b, n_a, n_b, piece, len(places))):
            texts[place] = text
        owner = places[codes // self.span]
        self.broken |= not whole.all()
        self.texts += texts
        self.counts = np.concatenate([self.counts, counts])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.bincount(owner, minlength=len(new)))])
        self.codes = np.concatenate([self.codes, codes % self.span])
        self.times = np.concatenate([self.times, times])

    def _pairs(self, ids_a, ids_b, group_a, n_b, piece) -> tuple[np.ndarray, np.ndarray]:
        """piece * span + pair, ascending, and how often it is linked; a bounded number of links
        is expanded at once."""
        first_b = np.cumsum(n_b) - n_b
        links = np.cumsum(n_b[group_a])
        keys, times, at = [], [], 0
        while at < len(ids_a):
            stop = max(at + 1, int(np.searchsorted(links, (links[at - 1] if at else 0) + EXPANDED, "right")))
            group = group_a[at:stop]
            b = ids_b[_ranges(first_b[group], n_b[group])]
            key = np.repeat(piece[group] * self.span + ids_a[at:stop] * len(self.b.bytes), n_b[group]) + b
            key, n = _sums(key, np.ones(len(key), np.int64))
            keys.append(key)
            times.append(n)
            at = stop
        if len(keys) == 1:
            return keys[0], times[0]
        none = [np.zeros(0, np.int64)]
        return _sums(np.concatenate(keys + none), np.concatenate(times + none))

    def _texts(self, ids_a, ids_b, group_a, group_b, n_a, n_b, piece, n: int) -> Iterator[str]:
        """Groups of each piece as `a1,a2|b1;a3|b2`."""
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        place_a = np.arange(len(ids_a)) + (upto_b - n_b)[group_a]
        place_b = np.arange(len(ids_b)) + upto_a[group_b]
        marked = np.zeros(len(ids_a) + len(ids_b), np.int64)
        marked[place_a], marked[place_b] = ids_a, ids_b
        last = upto_a + upto_b - 1
        marked[upto_a + upto_b - n_b - 1] += self.width
        ends_piece = np.append(piece[1:] != piece[:-1], True) if len(piece) else np.zeros(0, bool)
        marked[last] += np.where(ends_piece, 3, 2) * self.width
        names = self.names
        parts = [names[i] for i in marked.tolist()]
        at = 0
        for end in (last[ends_piece] + 1).tolist():
            yield "".join(parts[at:end])
            at = end


def coalesce(sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group of each token A, of each token B, and the first byte of each group, from the sizes
    of tokens that cover the same bytes in order."""
    ends = np.concatenate([np.cumsum(sizes_a), np.cumsum(sizes_b)])
    starts = ends - np.concatenate([sizes_a, sizes_b])
    side = np.repeat([0, 1], [len(sizes_a), len(sizes_b)])
    order = np.lexsort((side, starts))
    begins, reach = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.append(True, begins[1:] >= reach[:-1]) if len(order) else np.zeros(0, bool)
    group = np.zeros(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return group[:len(sizes_a)], group[len(sizes_a):], begins[fresh]


@lru_cache(maxsize=2)
def _aligned(path_a: str, path_b: str) -> Aligned:
    return Aligned(Side(path_a), Side(path_b))


def safe_cuts(found: Aligned) -> bool:
    return found.a.safe and found.b.safe


def align_texts(found: Aligned, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Per text: counts and group text; number of pairs; then all pairs and their times."""
    cut = [pieces(text, safe_cuts(found)) if text else [] for text in texts]
    if found.held > HELD:
        found.clear()
    numbers = found.numbers([p for own in cut for p in own])
    if found.broken:
        for i, text in enumerate(texts):
            if any(found.texts[found.known[p]] is None for p in cut[i]):
                whole = int(found.numbers([text])[0])  # the text decides, not its parts
                cut[i] = [text] if found.texts[whole] is not None else []
        numbers = np.array([found.known[p] for own in cut for p in own], np.int64)
    sizes = np.array([len(own) for own in cut], np.int64)
    ends = np.cumsum(np.append(0, sizes))
    counts = np.zeros((len(texts), 4), np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    np.add.at(counts, owner, found.counts[numbers])
    groups = [";".join([found.texts[n] for n in numbers[a:b].tolist()]) for a, b in zip(ends[:-1], ends[1:])]
    pieces_in_texts, often = _sums(owner * len(found.known) + numbers, np.ones(len(numbers), np.int64))
    text, piece = np.divmod(pieces_in_texts, max(len(found.known), 1))
    n_pairs = found.ends[piece + 1] - found.ends[piece]
    at = _ranges(found.ends[piece], n_pairs)
    keys, times = _sums(np.repeat(text, n_pairs) * found.span + found.codes[at], np.repeat(often, n_pairs) * found.times[at])
    return counts, groups, np.bincount(keys // found.span, minlength=len(texts)), keys % found.span, times


def aligned_rows(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """key, id, n_a, n_b, n_groups, n_links, groups_sha256, and the different linked pairs with
    their times; a pair is the id of A times the size of B's vocabulary plus the id of B."""
    rows = common.columns_of(docs, id=id_column, text=text).select(
        F.monotonically_increasing_id().alias("key"), "id", "text")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _aligned(path_a, path_b)
        for batch in common.byte_sized(batches, "text", 2 << 20):
            counts, groups, sizes, codes, times = align_texts(found, batch.column("text").to_pylist())
            ends = pa.array(np.cumsum(np.append(0, sizes)), pa.int32())
            digests = [sha256(g.encode()).hexdigest() if g else "" for g in groups]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("id"), *(pa.array(counts[:, i]) for i in range(4)), pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(ends, pa.array(codes)), pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))],
                names=["key", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    kind = rows.schema["id"].dataType.simpleString()
    return common.map_batches(rows, of_batches, f"key long, id {kind}, n_a long, n_b long, n_groups long, n_links long, "
                                                "groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (no pair of its A id has more)."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counted = written_table(counted, "pair-counts")
    of_a = F.expr(f"pair div {size_b}").alias("a")
    highest = counted.select(of_a, "n").groupBy("a").agg(F.max("n").alias("highest"))
    return counted.select("pair", "n", of_a).join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _looked_up(aligned: DataFrame, counts: DataFrame, size_b: int) -> DataFrame:
    """key, n_best, count_sum of each document."""
    n_pairs = counts.count()
    n_lookups = aligned.agg(F.coalesce(F.sum(F.size("pairs")), F.lit(0))).first()[0]
    fragments = -(-n_pairs // PAIRS) or 1
    while math.gcd(fragments, size_b) > 1:
        fragments += 1
    parts = -(-n_lookups // (fragments * LOOKUPS)) or 1

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("fragment", pa.int64()), ("part", pa.int64()), ("keys", pa.list_(pa.int64())),
                            ("sizes", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])
        for batch in (whole.slice(at, DEALT) for whole in batches for at in range(0, whole.num_rows, DEALT)):
            lists, keys = batch.column("pairs"), batch.column("key").to_numpy()
            pairs, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            place = np.repeat(np.arange(len(keys)), np.diff(lists.offsets.to_numpy()))
            order = np.argsort(pairs % fragments, kind="stable")
            ends = np.append(0, np.cumsum(np.bincount(pairs % fragments, minlength=fragments)))
            part = int(keys[0]) * 0x9E3779B97F4A7C15 % (1 << 64) % 0xFFFFFFFB % parts
            for fragment in np.flatnonzero(np.diff(ends)).tolist():
                at = order[ends[fragment]:ends[fragment + 1]]
                own, n = np.unique(place[at], return_counts=True)
                yield common.batch_of(schema, [fragment], [part], [keys[own]], [n], [pairs[at]], [times[at]])

    asked = common.map_batches(aligned.select("key", "pairs", "times"), dealt, "fragment long, part long, keys array<long>, "
                               "sizes array<int>, pairs array<long>, times array<int>")
    bundle = F.pmod(F.xxhash64("pair"), F.lit(64))
    bundles = counts.groupBy(F.expr(f"pair % {fragments}").alias("fragment"), bundle.alias("bundle")).agg(
        F.collect_list(F.struct("pair", "n", "best")).alias("known"))
    known = written_table(bundles, "pair-bundles").select(
        "fragment", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), "known")

    def of_group(asked: pa.Table, known: pa.Table) -> pa.Table:
        schema = pa.schema([("key", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())])
        if not asked.num_rows:
            return schema.empty_table()
        flat = [c.to_numpy(zero_copy_only=False) for c in known.column("known").combine_chunks().flatten().flatten()]
        order = np.argsort(flat[0])
        pair, n, best = (c[order] for c in flat)
        keys, sizes, pairs, times = (asked.column(c).combine_chunks().flatten().to_numpy() for c in ("keys", "sizes", "pairs", "times"))
        at = np.searchsorted(pair, pairs)
        first = np.cumsum(sizes, dtype=np.int64) - sizes
        return pa.Table.from_arrays([pa.array(keys), pa.array(np.add.reduceat(best[at] * times.astype(np.int64), first)),
                                     pa.array(np.add.reduceat(n[at] * times, first))], schema=schema)

    return asked.groupBy("fragment", "part").cogroup(known.groupBy("fragment", "part")).applyInArrow(
        of_group, "key long, n_best long, count_sum long")


def align(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best (links whose pair no other
    pair of its A id beats), count_sum (of the pair counts over all links), groups_sha256."""
    size_b = len(Side(path_b).bytes)
    aligned = written_table(aligned_rows(docs, path_a, path_b, id_column, text), "aligned")
    counts = written_table(pair_counts(aligned, size_b), "pairs")
    sums = _looked_up(aligned, counts, size_b).groupBy("key").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = F.lit(0).cast("long")
    return aligned.select("key", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "key", "left").select(
        F.col("id").alias(id_column), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
