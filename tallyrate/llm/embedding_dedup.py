"""Near-duplicate embeddings by PCA-ordered comparison in tiles.

Vectors are scaled to length one and turned so that their leading coordinates hold most of the
variance. Within a label they are dealt to cells along the first coordinate, wide enough that
linked vectors lie in the same or in neighbouring cells, and cells are cut into bounded tiles.
A tile adds up leading dimensions first; a pair goes on only while its sum, plus the product of
the norms of what is left, can reach the threshold. What remains is decided by its cosine in
double precision from the vectors as given. Equal vectors are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrate.llm import common
from tallyrate.storage import written_table

TILE = 1024
# Leading dimensions of the first product, and by how many the later sums grow.
LEAD, STEP = 8, 16
SLACK = 1e-9
# Pairs that are summed up at a time.
PAIRS = 50_000
# Vector lengths that get axes of their own; any other keeps the given axes, with equal results.
TURNED_LENGTHS = 8


def usable(embedding: Column, label: Column) -> Column:
    """Whether a vector can link: labelled, not null, all components finite, one not zero."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(label.isNotNull() & F.forall(embedding, number)
                      & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Axes by vector length, strongest first, from the second moments of all unit vectors. One
    row per matrix entry reaches the driver, for at most `TURNED_LENGTHS` lengths."""
    common_sizes = [row.dim for row in vectors.groupBy("dim").count().orderBy(
        F.col("count").desc(), "dim").limit(TURNED_LENGTHS).collect()]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for size in np.unique(sizes).tolist():
                own = _unit(_matrix(batch.column("v").filter(pa.array(sizes == size)), size))
                sums[size] = sums.get(size, 0) + own.T @ own
        for size, total in sums.items():
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(i), size), pa.int32()), pa.array(i, pa.int32()),
                pa.array(j, pa.int32()), pa.array(total[i, j])], ["dim", "i", "j", "x"])

    rows = common.map_batches(vectors.where(F.col("dim").isin(common_sizes)).select("dim", "v"), moments,
                              "dim int, i int, j int, x double")
    found = {size: np.zeros((size, size)) for size in common_sizes}
    for row in rows.groupBy("dim", "i", "j").agg(F.sum("x").alias("x")).toLocalIterator():
        found[row.dim][row.i, row.j] = found[row.dim][row.j, row.i] = row.x
    return {size: np.linalg.eigh(m)[1][:, ::-1] for size, m in found.items()}


def link_matrix(vectors: np.ndarray, axes: np.ndarray | None, allowed: np.ndarray,
                threshold: float) -> np.ndarray:
    """Symmetric matrix of the allowed pairs whose cosine reaches the threshold."""
    turned = _unit(vectors) if axes is None else _unit(vectors) @ axes
    size = turned.shape[1]
    stops = [*range(LEAD, size, STEP), size]
    # left[k]: norm of what lies behind the k-th stop
    left = [np.sqrt(np.maximum(0, (turned[:, stop:] ** 2).sum(axis=1))) for stop in stops]
    lead = turned[:, :stops[0]]
    maybe = np.triu(allowed & (lead @ lead.T + np.outer(left[0], left[0]) >= threshold - SLACK), 1)
    first, second = np.nonzero(maybe)
    links = np.zeros(allowed.shape, bool)
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    norms = np.sqrt((scaled * scaled).sum(axis=1))
    for at in range(0, len(first), PAIRS):
        i, j = first[at:at + PAIRS], second[at:at + PAIRS]
        sums = (lead[i] * lead[j]).sum(axis=1)
        for k in range(1, len(stops)):
            part = slice(stops[k - 1], stops[k])
            sums = sums + (turned[i, part] * turned[j, part]).sum(axis=1)
            go = sums + left[k][i] * left[k][j] >= threshold - SLACK
            i, j, sums = i[go], j[go], sums[go]
        cosine = (scaled[i] * scaled[j]).sum(axis=1) / (norms[i] * norms[j])
        i, j = i[cosine >= threshold], j[cosine >= threshold]
        links[i, j] = links[j, i] = True
    return links


def spanning_links(links: np.ndarray) -> list[tuple[int, int]]:
    """A forest with the same components as the matrix."""
    out, new = [], links.any(axis=1)
    while new.any():
        front = [int(np.argmax(new))]
        new[front[0]] = False
        while front:
            at = front.pop()
            reached = np.flatnonzero(links[at] & new)
            new[reached] = False
            out += [(at, int(r)) for r in reached]
            front += reached.tolist()
    return out


def _tile_results(dealt: DataFrame, axes: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """(a, b, weight): rows with b are links; rows without say how many rows a's links hold."""
    keys = ["group", "dim", "cell", "ti", "tj"]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in common.grouped(batches, keys):
            a, b, weights = [], [], []
            for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
                part = table.slice(start, stop - start)
                size, ti, tj = (part.column(c)[0].as_py() for c in ("dim", "ti", "tj"))
                nodes, copies, home, own = (part.column(c).to_numpy() for c in ("node", "copies", "home", "tile"))
                vectors = _matrix(part.column("v").combine_chunks(), size)
                # Pairs within a tile belong to its pair with the next tile alone.
                tiles = part.column("tiles")[0].as_py()
                inner = {t for t in {ti, tj} if {ti, tj} == {t, (t + 1) % tiles}}
                same = own[:, None] == own[None, :]
                allowed = (home[:, None] | home[None, :]) & (
                    ~same | np.isin(own, list(inner))[:, None])
                links = link_matrix(vectors, axes.get(size), allowed, threshold)
                held = links @ copies
                some = np.flatnonzero(held)
                a += nodes[some].tolist()
                b += [None] * len(some)
                weights += held[some].tolist()
                for i, j in spanning_links(links):
                    a.append(int(nodes[i]))
                    b.append(int(nodes[j]))
                    weights.append(0)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                              pa.array(weights, pa.int64())], ["a", "b", "weight"])

    return common.map_batches(dealt.repartition(*keys).sortWithinPartitions(*keys, "node"), of_batches,
                              "a long, b long, weight long")


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", embedding: str = "embedding",
                    label: str = "label", threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Only vectors of the same non-null label and the same length are compared. Vectors that are
    null, empty or zero, or hold null or non-finite components, link with nothing and are their
    own component. Repeated rows are linked with each other and count each as a link. A null id
    is never a component's least unless it has no other. Other columns are not read. `threshold`
    must be above 0.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the cosine threshold must be above 0 and at most 1")
    rows = common.columns_of(vectors, id=id_column, v=embedding, label=label).select(
        "id", F.col("v").cast("array<double>").alias("v"), "label").withColumn(
        "ok", usable(F.col("v"), F.col("label")))
    rows = written_table(rows, "vectors")
    distinct = written_table(rows.where("ok").groupBy("label", "v").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")).select(
        F.monotonically_increasing_id().alias("node"), "label", "v", "least", "copies",
        F.size("v").alias("dim")), "distinct-vectors")
    axes = principal_axes(distinct)
    width = float(np.sqrt(2 - 2 * threshold)) + SLACK

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            out = np.zeros(len(sizes), np.int32)
            for size in np.unique(sizes).tolist():
                own = sizes == size
                unit = _unit(_matrix(batch.column("v").filter(pa.array(own)), size))
                first = unit @ axes[size][:, 0] if size in axes else unit[:, 0]
                out[own] = np.floor(first / width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "cell"])

    known = distinct.select("node", F.col("label").cast("string").alias("group"), "dim", "copies", "v")
    placed = common.map_batches(known, cells, "node long, group string, dim int, copies long, v array<double>, cell int")
    # A cell's task also sees the next cell, whose rows are then not compared with each other.
    both = placed.select("node", "group", "dim", "copies", "v", F.explode(F.array(
        F.struct("cell", F.lit(True).alias("home")),
        F.struct((F.col("cell") - 1).alias("cell"), F.lit(False).alias("home")))).alias("x")).select(
        "node", "group", "dim", "copies", "v", F.col("x.cell").alias("cell"), F.col("x.home").alias("home"))
    both = written_table(both, "cells")
    dealt = common.tiled(both, ["group", "dim", "cell"], F.xxhash64("node"), tile, "cell-sizes")
    results = written_table(_tile_results(dealt, axes, threshold), "tile-links")
    sums = written_table(results.where("b is null").groupBy(F.col("a").alias("node")).agg(
        F.sum("weight").alias("weight")), "link-counts")
    groups = written_table(common.components(results.where("b is not null")), "components")
    named = distinct.drop("dim").join(sums, "node", "left").join(groups, "node", "left").select(
        "label", "v", "least", F.coalesce("component", "node").alias("component"),
        (F.coalesce("weight", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    named = written_table(named, "named-vectors")
    lowest = written_table(named.groupBy("component").agg(F.min("least").alias("component_id")), "component-ids")
    known = written_table(named.join(lowest, "component").select("label", "v", "n_links", "component_id"),
                          "vector-results")
    linked = rows.where("ok").join(known, ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
