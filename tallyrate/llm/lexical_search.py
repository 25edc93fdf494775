"""Ranked lexical search over a length-stratified index.

Documents whose length gives the same normaliser m form a stratum. A stratum lists, for each
term and number of occurrences tf, the documents that have the term so often; what one
occurrence pattern is worth depends on (tf, m) alone and is computed once. The greatest tf of
each term bounds what any document of a stratum can score for an item, so strata are visited by
falling bound until the bound is below the k-th score found.

Strata are packed into shards of about SHARD postings; a stratum with more is dealt over several
shards by document, so neither a common length nor a common term meets in one task. Items are
searched in blocks of about BLOCK. Each (block, shard) gives its k best rows per item, and the k
best of those are the result.

A null text has no terms. Every row is a document or an item of its own, also where ids repeat
or are null; a null document id comes last among equal scores. Documents without terms are not
counted, items without terms find nothing. Very long texts are read whole, a byte-sized batch at
a time. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrate.llm import common
from tallyrate.storage import written_table

SHARD, BLOCK = 250_000, 1_000
# Share of the document length in the normaliser, in hundredths.
SLOPE = 75
# Stands for a null id inside the shards; ids are long.
NO_ID = (1 << 63) - 1
# Terms whose place in the vocabulary one worker remembers.
REMEMBERED = 500_000

_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased."""
    return (text or b"").translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Index:
    """`postings` (shard, m, term, tf, docs), `weights` (term, w), and the two totals."""
    postings: DataFrame
    weights: DataFrame
    n_documents: int
    n_terms: int


class _Vocabulary:
    def __init__(self, bits: np.ndarray | None):
        self.bits, self.known = bits, {}

    def has(self, term: bytes) -> bool:
        found = self.known.get(term)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            place = xxhash.xxh64_intdigest(term, 42) & (common.FILTER_BITS - 1)
            found = self.known[term] = bool(self.bits[place >> 3] >> (place & 7) & 1)
        return found


def counted(rows: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """Of (id, text): row, id, n (terms with repeats), terms and tfs (each different term once).
    With `bits`, terms that are surely not in that vocabulary are left out, but counted in n."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(bits)
        schema = pa.schema([("n", pa.int64()), ("terms", pa.list_(pa.string())), ("tfs", pa.list_(pa.int32()))])
        for batch in common.byte_sized(batches, "text"):
            sizes, found, times = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                own = terms(text)
                tf = Counter(own)
                kept = list(tf) if bits is None else [t for t in tf if vocabulary.has(t)]
                sizes.append(len(own))
                found.append([t.decode("utf-8") for t in kept])
                times.append([tf[t] for t in kept])
            made = common.batch_of(schema, sizes, found, times)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), *made.columns], names=["row", "id", "n", "terms", "tfs"])

    kind = rows.schema["id"].dataType.simpleString()
    return common.map_batches(rows.select(F.monotonically_increasing_id().alias("row"), "id", "text"), of_batches,
                              f"row long, id {kind}, n long, terms array<string>, tfs array<int>")


def _exploded(found: DataFrame, *columns: str) -> DataFrame:
    pairs = F.explode(F.arrays_zip("terms", "tfs"))
    return found.select(*columns, pairs.alias("pair")).select(
        *columns, F.col("pair.terms").alias("term"), F.col("pair.tfs").alias("tf"))


def _normaliser(n: Column, n_documents: int, n_terms: int) -> Column:
    share = F.expr(f"({SLOPE} * n * {n_documents}L) div {max(n_terms, 1)}L")
    return F.lit(100 - SLOPE) + share


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None, id_column: str = "doc_id",
                text: str = "text", shard: int = SHARD) -> Index:
    """The index of every document, for the terms of `vocabulary` (a column `term`) or, without
    one, for all terms. Ids are of an integer type."""
    bits = None
    if vocabulary is not None:
        bits = common.key_bits(vocabulary.select(F.xxhash64("term").alias("h")), "h")
    rows = common.columns_of(docs, id=id_column, text=text).withColumn("id", F.col("id").cast("long"))
    found = written_table(counted(rows, bits), "term-counts")
    totals = found.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_documents, n_terms = int(totals[0]), int(totals[1])
    placed = _exploded(found.withColumn("m", _normaliser(F.col("n"), n_documents, n_terms)), "row", "id", "m")
    sizes = found.withColumn("m", _normaliser(F.col("n"), n_documents, n_terms)).groupBy("m").agg(
        F.sum(F.size("terms")).alias("size")).where("size > 0")
    strata = written_table(common.running_sums(written_table(sizes, "stratum-sizes"), [F.col("m")], before="size").select(
        "m", F.expr(f"before div {shard}").alias("first"), F.ceil(F.col("size") / shard).alias("slices")), "strata")
    dealt = placed.join(strata, "m").withColumn(
        "shard", F.col("first") + F.pmod(F.xxhash64("row"), F.col("slices")))
    doc = F.struct(F.coalesce("id", F.lit(NO_ID)).alias("id"), "row")
    postings = written_table(dealt.groupBy("shard", "m", "term", "tf").agg(F.collect_list(doc).alias("docs")), "postings")
    held = postings.groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    ratio = F.lit(2.0 * n_documents + 2) / (2 * F.col("df") + 1)
    weights = written_table(held.select("term", F.floor(1000 * F.log(ratio)).alias("w")), "term-weights")
    return Index(postings, weights, n_documents, n_terms)


def item_terms(items: DataFrame, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """row, id, term, tf of each item, written."""
    return written_table(_exploded(counted(common.columns_of(items, id=id_column, text=text)), "row", "id"), "item-terms")


class _Shard:
    """The postings of one shard by (stratum, term), with what each is worth."""

    def __init__(self, postings: pa.Table):
        listed = postings.column("term").combine_chunks()
        self.vocabulary = pc.unique(listed)
        term = pc.index_in(listed, self.vocabulary).to_numpy().astype(np.int64)
        m, tf = postings.column("m").to_numpy(), postings.column("tf").to_numpy().astype(np.int64)
        strata, stratum = np.unique(m, return_inverse=True)
        self.n_strata, n = len(strata), len(self.vocabulary)
        order = np.argsort(stratum * n + term, kind="stable")
        impacts = ((1_000_000_000 * tf) // (1000 * tf + 8 * m))[order]
        self.keys, first = np.unique((stratum * n + term)[order], return_index=True)
        self.highest = np.maximum.reduceat(impacts, first)
        docs = postings.column("docs").combine_chunks()
        begins, sizes = docs.offsets.to_numpy()[:-1][order], np.diff(docs.offsets.to_numpy())[order]
        ends = np.cumsum(sizes, dtype=np.int64)
        places = np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1])
        self.starts = np.append((ends - sizes)[first], ends[-1])
        self.impact = np.repeat(impacts, sizes)
        ids, rows = (part.to_numpy(zero_copy_only=False) for part in docs.values.flatten())
        self.rows, self.doc = np.unique(rows[places], return_inverse=True)
        self.ids = np.zeros(len(self.rows), np.int64)
        self.ids[self.doc] = ids[places]

    def best(self, asked: pa.Array, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the k best documents and their scores; strata are visited by falling bound.
        Scores stay below 2 ** 53, so sums in doubles are exact."""
        codes = pc.index_in(asked, self.vocabulary)
        weights = weights[pc.is_valid(codes).to_numpy(zero_copy_only=False)]
        codes = codes.drop_null().to_numpy().astype(np.int64)
        wanted = np.arange(self.n_strata)[:, None] * len(self.vocabulary) + codes[None, :]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        known = self.keys[at] == wanted
        bounds = (np.where(known, self.highest[at], 0) * weights).sum(axis=1)
        order = np.argsort(-bounds, kind="stable")
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        visited, step = 0, 4
        while visited < len(order):
            least = scores[-1] if len(scores) == k else 1
            strata = order[visited:visited + step]
            strata = strata[bounds[strata] >= least]
            if not len(strata):
                break
            more, found = self._scores(at[strata][known[strata]],
                                       np.broadcast_to(weights, at.shape)[strata][known[strata]], least)
            docs, scores = np.append(docs, more), np.append(scores, found)
            if len(scores) > k:
                near = scores >= np.partition(scores, -k)[-k]
                docs, scores = docs[near], scores[near]
            top = np.lexsort((self.rows[docs], self.ids[docs], -scores))[:k]
            docs, scores = docs[top], scores[top]
            visited, step = visited + step, step * 4
        return docs, scores

    def _scores(self, at: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that reach `least` by the postings of these keys."""
        starts, sizes = self.starts[at], self.starts[at + 1] - self.starts[at]
        places = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        sums = np.bincount(self.doc[places], weights=np.repeat(weights, sizes) * self.impact[places])
        docs = np.flatnonzero(sums >= least)
        return docs, sums[docs].astype(np.int64)


def search(index: Index, items: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of each item (row, id, term, tf, from
    `item_terms`) with the highest scores above 0, equal scores by ascending id. Without
    documents or items there are no rows."""
    n_items = items.agg(F.count_distinct("row")).first()[0]
    number = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-n_items // block)))).alias("block")
    asked = items.join(index.weights, "term").where("w > 0").select(
        number, "row", "id", F.struct("term", (F.col("tf") * F.col("w")).alias("w")).alias("asked"))
    asked = written_table(asked.groupBy("block", "row", "id").agg(F.collect_list("asked").alias("asked")), "asked")
    vocabulary = written_table(items.select(number, "term").distinct(), "block-terms")
    listed = index.postings.join(vocabulary, "term").select("block", "shard", "m", "term", "tf", "docs")
    everywhere = asked.join(listed.select("block", "shard").distinct(), "block").select(
        F.col("block").alias("to_block"), F.col("shard").alias("to_shard"), "row", "id", "asked")
    kind = items.schema["id"].dataType.simpleString()

    def of_group(postings: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([queries.schema.field("row"), queries.schema.field("id"), pa.field("doc", pa.int64()),
                            pa.field("doc_row", pa.int64()), pa.field("score", pa.int64())])
        if not postings.num_rows or not queries.num_rows:
            return schema.empty_table()
        shard = _Shard(postings)
        asked = queries.column("asked").combine_chunks()
        found = [shard.best(terms.field("term"), terms.field("w").to_numpy(), k)
                 for terms in (asked[i].values for i in range(len(asked)))]
        sizes = [len(docs) for docs, _ in found]
        docs = np.concatenate([docs for docs, _ in found])
        item = np.repeat(np.arange(len(found)), sizes)
        return pa.Table.from_arrays([
            queries.column("row").take(item), queries.column("id").take(item), pa.array(shard.ids[docs]),
            pa.array(shard.rows[docs]), pa.array(np.concatenate([scores for _, scores in found]))], schema=schema)

    common.ship_package(listed.sparkSession)
    near = listed.groupBy("block", "shard").cogroup(
        everywhere.groupBy("to_block", "to_shard")).applyInArrow(
        of_group, f"row long, id {kind}, doc long, doc_row long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "doc", "doc_row")
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("item_id"), "rank", F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of each item, from an index of the items' terms."""
    asked = item_terms(items)
    return search(build_index(docs, asked.select("term").distinct()), asked, k)
