from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import xxhash

from tallyrate.llm import common, embedding_dedup, simhash
from tests.llm.fixtures import ODD_TEXTS, documents


def least_reachable(nodes, links):
    """Union-find over (node, id) pairs."""
    above = dict.fromkeys(nodes)
    def root(x):
        while above[x] is not None:
            x = above[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            above[a] = b
    groups = {}
    for x in nodes:
        groups.setdefault(root(x), []).append(x)
    return {x: min(group) for group in groups.values() for x in group}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = list(range(0, 60))
    rng.shuffle(chain)
    links = list(itertools.pairwise(chain)) + [(100, i) for i in range(101, 160)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(300, 300), (301, 302), (302, 301)]
    found = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = least_reachable({x for link in links for x in link}, links)
    assert found == {k: v for k, v in want.items() if any(k in link and link[0] != link[1] for link in links)}


def test_components_of_nothing(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_difference(radius):
    masks = simhash.covering_masks(radius, 20)
    for places in itertools.combinations(range(20), radius):
        gone = sum(1 << p for p in places)
        assert any(m & gone == 0 for m in masks)


def slow_fingerprint(text, k):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace(
        "\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("tile", [4, 2048])
def test_simhash_matches_brute_force(spark, tile, monkeypatch):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(rng.choice([5, 60, 400]))] for _ in range(25)]
    texts = list(ODD_TEXTS)
    for text in base:
        texts.append(" ".join(text))
        for _ in range(rng.choice([0, 1, 6])):
            other = list(text)
            other[rng.randrange(len(other))] = "Changed"
            texts.append("\n".join(other))
    monkeypatch.setattr(simhash, "TILE", tile)
    found = {r.doc_id: r for r in simhash.near_duplicates(documents(spark, texts)).collect()}
    prints = {i: slow_fingerprint(t, 3) for i, t in enumerate(texts)}
    assert {i: r.fp % 2**64 for i, r in found.items()} == prints
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {i: r.component_id for i, r in found.items()} == least_reachable(prints, links)
    assert len(links) > 30


def test_large_buckets_are_cut_into_tiles_without_losing_links(spark):
    rng = random.Random(2)
    values = {rng.getrandbits(12) << 40 for _ in range(600)}
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    found = simhash.links(prints, 3, tile=16).collect()
    links = [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 3]
    assert least_reachable(values, [(r.a, r.b) for r in found]) == least_reachable(values, links)
    assert all((r.a ^ r.b).bit_count() <= 3 for r in found)


def test_simhash_keeps_one_row_of_each_component(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (3, text), (3, text), (3, "other words entirely"), (9, "quite alone here"), (None, "no id"),
            (None, "no id"), (None, text), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as _row")
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str)
    assert kept == sorted([(3, text), (3, "other words entirely"), (9, "quite alone here"), (None, "no id"),
                           (7, None)], key=str)
    assert simhash.keep_one(docs).columns == docs.columns
    assert simhash.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [8, 1024])
def test_embeddings_match_brute_force(spark, tile):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24)) * np.linspace(2, 0.2, 24)
    rows = []
    for i in range(150):
        v = centres[i % 12] + rng.normal(size=24) * rng.choice([0.02, 0.2, 0.5])
        rows.append((i, v.tolist(), int(i % 12 % 3) if i % 17 else None))
    rows += [(150 + i, rows[1][1], 1) for i in range(9)]
    rows += [(200, None, 1), (201, [0.0] * 24, 1), (202, [float("nan")] * 24, 1), (203, [None] * 24, 1), (204, [], 1),
             (205, [1.0, 2.0], 1), (206, [2.0, 4.0], 1), (207, [1e300] + [0.0] * 23, 0), (208, [1e-300] + [0.0] * 23, 0),
             (209, [float("inf")] + [0.0] * 23, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as node", "2 as cell")
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame, tile=tile).collect()}

    def good(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        a, b = np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max()
        return a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)

    links = [(a[0], b[0]) for a, b in itertools.combinations(rows, 2)
             if a[2] is not None and a[2] == b[2] and good(a[1]) and good(b[1]) and len(a[1]) == len(b[1])
             and cosine(a[1], b[1]) >= 0.93]
    assert len(links) > 100
    counts = {r[0]: sum(r[0] in link for link in links) for r in rows}
    assert {i: r.n_links for i, r in found.items()} == counts
    want = least_reachable([r[0] for r in rows], links)
    assert {i: r.component_id for i, r in found.items()} == want
    assert {i: r.kept for i, r in found.items()} == {i: i == c for i, c in want.items()}


def test_no_embeddings(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(frame).count() == 0
    only_bad = spark.createDataFrame([(1, None, 2)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in embedding_dedup.near_duplicates(only_bad).collect()] == [(1, 0, 1, True)]
