from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyrate.llm import bpe, token_counts, tokens
from tests.llm.fixtures import ODD_TEXTS, documents, random_text

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    passage = random_text(rng, 900)
    own = [random_text(rng, rng.choice([3, 40, 400])) for _ in range(25)]
    mixed = [a + passage + b for a, b in zip(own, reversed(own))]
    return [*ODD_TEXTS, *own, *mixed, *mixed[:4], random_text(rng, 30_000), "é" * 20_000, "ab" * 9000, " " * 5000]


@pytest.mark.parametrize("name", FILES)
def test_pieces_give_the_ids_of_the_whole_text(texts, name):
    path = tokens.public_path(name)
    library = tokens.load(path)
    for text in texts:
        want = library.encode(text or "", add_special_tokens=False).ids
        got = bpe.encode_text(path, text or "")
        assert [int(x) for x in memoryview(got).cast("i")] == want, repr((text or "")[:80])


@pytest.mark.parametrize("name", FILES)
def test_encode_matches_the_library(spark, texts, name):
    path = tokens.public_path(name)
    library = tokens.load(path)
    rows = bpe.encode(documents(spark, texts), path).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == want
        assert row.decoded == library.decode(want, skip_special_tokens=False)


def test_shared_chunks_are_found_and_rebuild_the_text(texts):
    passage = max(texts, key=lambda t: len(t or ""))[:60_000]
    a = [d for d, _ in bpe.chunks(("first " * 80 + passage).encode())]
    b = [d for d, _ in bpe.chunks(("another start " + passage).encode())]
    assert len(set(a) & set(b)) > 10
    for text in texts:
        parts = [part for _, part in bpe.chunks((text or "").encode())]
        assert b"".join(parts).decode() == (text or "")
        assert all(len(p) <= bpe.MOST for p in parts)


@pytest.mark.parametrize("name", FILES)
def test_chunk_joins_are_exact(texts, name):
    path = tokens.public_path(name)
    for text in texts:
        own = {d: bpe.chunk_parts(path, p.decode()) for d, p in bpe.chunks((text or "").encode())}
        assert bpe.encode_with(path, text or "", own) == bpe.encode_text(path, text or "")


@pytest.mark.parametrize("name", FILES)
def test_counts_match_the_library(spark, texts, name):
    path = tokens.public_path(name)
    library = tokens.load(path)
    found = token_counts.with_limit(token_counts.count(documents(spark, texts), path), 512).collect()
    assert len(found) == len(texts)
    for row in found:
        text = texts[row.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 512)


def test_a_small_cache_changes_nothing(texts, monkeypatch):
    path = tokens.public_path(FILES[0])
    found = tokens.pieces(texts[-4])[1:]
    want = [len(tokens.load(path).encode(" " + p, add_special_tokens=False).ids) for p in found]
    for held, longest, joined in ((10, 400, 1 << 17), (5000, 3, 50), (64 << 20, 400, 1)):
        monkeypatch.setattr(tokens, "HELD", held)
        monkeypatch.setattr(tokens, "LONGEST", longest)
        monkeypatch.setattr(tokens, "JOINED", joined)
        cache = tokens.PieceCache(path, len)
        assert cache.of_spaced(found) == want
        assert [n for at in range(0, len(found), 77) for n in cache.of_spaced(found[at:at + 77])] == want


def test_the_cache_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "HELD", 100_000)
    cache = tokens.PieceCache(tokens.public_path(FILES[0]), len)
    for start in range(0, 20_000, 500):
        cache.of_spaced([f"word{i}" for i in range(start, start + 500)] + ["x" * 5000 + str(start)])
    for kept in (cache.young, cache.old):
        assert 0 < sum(tokens.ENTRY + 2 * len(p) for p in kept) <= 100_000 + tokens.ENTRY + 2 * tokens.LONGEST
        assert max(map(len, kept)) <= tokens.LONGEST
    assert cache.of_spaced(["word19999"]) == tokens.PieceCache(tokens.public_path(FILES[0]), len).of_spaced(["word19999"])


def test_repeated_rows_share_no_chunk(spark):
    rng = random.Random(8)
    unlike = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(600)) for _ in range(12)]
    docs = documents(spark, unlike)
    rows = docs.union(docs).union(docs).selectExpr("doc_id as id", "text", "xxhash64(doc_id, text) as key")
    seen = bpe._occurrences(rows)
    assert seen.groupBy("chunk").agg({"key": "min"}).count() == seen.distinct().count() > 50
    assert seen.groupBy("chunk").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a < b").count() == 0
    path = tokens.public_path(FILES[0])
    once = {r.doc_id: (r.ids, r.decoded) for r in bpe.encode(docs, path).collect()}
    thrice = bpe.encode(docs.union(docs).union(docs), path).collect()
    assert len(thrice) == 36 and all(once[r.doc_id] == (r.ids, r.decoded) for r in thrice)


def test_empty_tables(spark):
    empty = documents(spark, []).limit(0)
    path = tokens.public_path(FILES[0])
    assert bpe.encode(empty, path).count() == 0
    assert token_counts.count(empty, path).count() == 0
