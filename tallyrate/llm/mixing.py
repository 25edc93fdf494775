"""Mixing sources to target weights by hash thresholds, with DataFrame operations only.

Every row has a hash of its id. A source whose target is between k and k+1 times its size gives
k copies of all its rows and one more of the rows whose hash lies below a threshold. Thresholds
come from histograms: tokens are summed by source and leading hash bits, and only the bucket in
which the budget runs out is looked at again, by its next bits. Nothing is sorted but the rows of
one hash at the threshold, which are told apart by their text and then by their place in the input;
smaller budgets take subsets of what larger ones take.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrate.llm import common
from tallyrate.storage import written_table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3

# Hash bits, and the bits by which one histogram refines the one before.
HASH_BITS, STEP_BITS = 36, 12


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def row_hash(id_column: Column, text: Column) -> Column:
    """36 bits of the MD5 of the id's text, of the text itself where the id is null."""
    key = F.coalesce(id_column.cast("string"), text.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def tie_hash(text: Column) -> Column:
    """60 bits of the MD5 of the text, to order rows of one hash."""
    return F.conv(F.substring(F.md5(F.coalesce(text.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def sized_rows(docs: DataFrame, id_column: str = "doc_id", source: str = "source",
               text: str = "text") -> DataFrame:
    rows = common.columns_of(docs, id=id_column, source=source, text=text)
    return rows.select("id", "source", word_count(F.col("text")).alias("size"),
                       row_hash(F.col("id"), F.col("text")).alias("hash"), tie_hash(F.col("text")).alias("tie"),
                       F.monotonically_increasing_id().alias("place"))


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target: all words shared by weight, none above its limit.

    Sources by code point, null last, take the weights in turn. A target stops at `max_repeats`
    times its source's size; what is above is shared again by weight among the others. With the
    sources sorted by limit per weight, those before some place stop at their limit and the rest
    share what is left at one level per weight: the largest level that any place gives.
    """
    sizes = written_table(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    cycle = F.array(*(F.lit(int(w)) for w in weights))
    ranked = common.running_sums(sizes.withColumn("_one", F.lit(1)),
                                 [F.col("source").asc_nulls_last()], _rank="_one")
    weighed = ranked.select(
        "source", "source_size", F.get(cycle, F.col("_rank") % len(weights)).cast("long").alias("weight"),
        (F.col("source_size") * max_repeats).alias("most"))
    placed = written_table(common.running_sums(
        weighed, [F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()],
        most_before="most", weight_before="weight"), "weighed-sources")
    words, all_weights = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    level = placed.agg(F.max((F.lit(words or 0) - F.col("most_before"))
                             / (F.lit(all_weights or 1) - F.col("weight_before")))).first()[0]
    return placed.select("source", "source_size", F.least(
        F.col("most").cast("double"), F.col("weight") * F.lit(float(level or 0.0))).alias("target"))


def thresholds(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """source, source_size, target, whole, limit, rest, before: `whole` copies of every row and one
    more of rows with a hash below `limit`, which are `before` of the `rest` words still wanted.
    Rows whose hash is `limit` have more words than are left."""
    share = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    plan = wanted.withColumn("whole", F.coalesce(F.floor(share), F.lit(0))).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = written_table(plan, "mix-plan")
    edge = plan.select("source", "rest", F.lit(0).cast("long").alias("prefix"),
                       F.lit(0).cast("long").alias("before"))
    inside = sized
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        inside = _with(inside.select("source", "size", "hash"), edge, F.shiftright("hash", shift + STEP_BITS))
        if shift + STEP_BITS < HASH_BITS:  # a small part of the rows, read again below
            inside = written_table(inside, "boundary-rows")
        buckets = inside.groupBy("source", "rest", "before", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("words"))
        so_far = Window.partitionBy("source").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        summed = buckets.withColumn("upto", F.col("before") + F.sum("words").over(so_far))
        edge = written_table(summed.where("upto > rest").groupBy("source", "rest").agg(
            F.min_by(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "upto"),
                     "bucket").alias("x")).select(
            "source", "rest", F.col("x.bucket").alias("prefix"), F.col("x.before").alias("before"),
            F.col("x.upto").alias("upto")), "boundary")
    ends = edge.select(F.col("source").alias("_source"), F.col("prefix").alias("limit"), "before")
    return plan.join(ends, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("limit", F.lit(0)).alias("limit"), "rest", "before")


def _with(rows: DataFrame, edge: DataFrame, prefix: Column) -> DataFrame:
    """The rows in the boundary bucket of their source, with its budget."""
    known = edge.select(F.col("source").alias("_source"), "rest", "prefix", "before")
    return rows.withColumn("_prefix", prefix).join(
        known, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_prefix") == F.col("prefix"))
    ).select("source", "size", "hash", "rest", "before")


def _planned(rows: DataFrame, plan: DataFrame, size: Column) -> DataFrame:
    """`rows` (source, hash, tie, place, ...) with their source's plan and the copies the mix
    takes. Of the rows at the threshold, in order, each is taken that fits into what is left, and
    the next one where that comes nearer to the target."""
    known = plan.withColumnRenamed("source", "_source")
    found = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    at_limit = F.col("before").isNotNull() & (F.col("hash") == F.col("limit"))
    apart = found.where(~at_limit).withColumn("copies", F.col("whole") + (F.col("hash") < F.col("limit")).cast("long"))
    edge = written_table(found.where(at_limit).withColumn("_size", size), "threshold-rows")
    summed = written_table(common.running_sums(
        edge, [F.col("source").asc_nulls_last(), F.col("tie"), F.col("place")], _sum="_size"), "threshold-sums")
    first = summed.groupBy("source").agg(F.min("_sum").alias("_first")).withColumnRenamed("source", "_source")
    had = F.col("before") + F.col("_sum") - F.col("_first")
    over = had + F.col("_size") - F.col("rest")
    taken = (over <= 0) | (over < F.col("rest") - had)
    edge = summed.join(first, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "copies", F.col("whole") + taken.cast("long"))
    return apart.unionByName(edge.select(*apart.columns))


def mix(docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text",
        weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken.

    A null text has size 0; null is a source of its own; sources without words get target 0.
    Rows with the same id have the same hash, rows without an id are told apart by their text.
    Where such rows lie at the threshold, as many of them are taken as come nearest to the target,
    by text and then by place; equal rows are equal in the result but for that. Texts of any length
    are counted whole. Other columns of `docs` are not read.
    """
    sized = written_table(sized_rows(docs, id_column, source, text), "sized")
    plan = thresholds(sized, targets(sized, weights, max_repeats))
    return _planned(sized, plan, F.col("size")).select(
        F.col("id").alias(id_column), "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"))


def mixed_rows(docs: DataFrame, id_column: str = "doc_id", source: str = "source",
               text: str = "text", weights: Sequence[int] = WEIGHTS,
               max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mix itself: each row of `docs` as often as it is taken, all columns."""
    sized = written_table(sized_rows(docs, id_column, source, text), "sized")
    plan = written_table(thresholds(sized, targets(sized, weights, max_repeats)), "mix-limits")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
                       F.col(f"`{source}`").alias("source"),
                       row_hash(F.col(f"`{id_column}`"), F.col(f"`{text}`")).alias("hash"),
                       tie_hash(F.col(f"`{text}`")).alias("tie"), F.monotonically_increasing_id().alias("place"))
    return _planned(rows, plan, word_count(F.col("_row").getField(text))).select(
        "_row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("_row.*")
