from __future__ import annotations

import hashlib
import random
import re

import pytest

from tallyrate.llm import exact_dedup
from tests.llm.fixtures import ODD_TEXTS, documents


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_force(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(norm(text), []).append(doc_id)
    for doc_id, text in rows:
        group = groups[norm(text)]
        ids = [x for x in group if x is not None]
        keep = min(ids) if ids else None
        yield doc_id, keep, len(group), doc_id == keep, hashlib.sha256(norm(text).encode()).hexdigest()


def test_duplicates_match_brute_force(spark):
    rng = random.Random(6)
    texts = [*ODD_TEXTS, *(rng.choice(["a b", "a  b", "a\tb", "a b ", "x", "x\u00a0y", "x y"]) for _ in range(80))]
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts)] + [(None, "a b"), (None, "lone"), (None, "lone"), (5, "q"), (5, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as digest", "2 as n", "3 as keep_id")
    found = exact_dedup.duplicates(docs).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in found], key=str) == sorted(
        brute_force(rows), key=str)


def test_one_row_of_each_group_stays(spark):
    rows = [(4, "a b"), (2, "a\nb"), (2, "a b"), (2, "c"), (None, "a b"), (None, "z"), (None, "z"), (9, None), (8, ""), (1, "tail ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _n", "2 as _row")
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, norm(r.text)) for r in kept.collect()), key=str) == sorted(
        [(2, "a b"), (2, "c"), (None, "z"), (8, ""), (1, "tail ")], key=str)
    assert exact_dedup.keep_one(docs.limit(0)).count() == 0
    assert exact_dedup.duplicates(documents(spark, []).limit(0)).count() == 0


def key(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_filter_inserts_deletes_and_resizes():
    rng = random.Random(2)
    found, live = exact_dedup.CuckooFilter(1), set()
    for _ in range(6000):
        i = rng.randrange(900)
        if i in live and rng.random() < 0.5:
            assert found.delete(key(i))
            live.discard(i)
        elif i not in live:
            number = found.insert(key(i))
            assert found.keys[number] == key(i)
            live.add(i)
    assert found.buckets > 64
    for i in range(1200):
        assert (found.find(key(i)) >= 0) == (i in live)
    assert not found.delete(key(5000))


def test_a_matching_print_is_not_a_hit():
    found = exact_dedup.CuckooFilter(16)
    first = bytes(32)
    other = first[:20] + b"\1" * 12  # the same bucket and print, another digest
    found.insert(first)
    assert found.find(other) == -1 and found.find(first) == 0
    found.insert(other)
    assert found.delete(first) and found.find(other) >= 0 and found.find(first) == -1


@pytest.mark.parametrize("rows", [5, 200_000])
def test_index_over_batches(spark, monkeypatch, rows):
    """Few rows a shard force more shards, so that the stored keys are dealt anew."""
    monkeypatch.setattr(exact_dedup, "SHARD_ROWS", rows)
    monkeypatch.setattr(exact_dedup, "SHARDS", 4)
    first = documents(spark, [f"text {i % 30}" for i in range(60)])
    index = exact_dedup.ExactIndex().insert(exact_dedup.digests(first))
    second = documents(spark, [f"text {i}" for i in range(25, 45)])
    index = index.insert(exact_dedup.digests(second))
    gone = exact_dedup.digests(documents(spark, ["text 1", "text 40", "never there"]))
    index = index.delete(gone)
    assert index.table.count() == 43
    ask = exact_dedup.digests(documents(spark, [f"text {i}" for i in range(50)]))
    found = {r.id: (r.keep_id, r.n) for r in index.lookup(ask).collect()}
    for i in range(50):
        n = 2 * (i < 30) + (25 <= i < 45)
        least = i if i < 30 else i - 25
        if 25 <= i < 30:
            least = min(i, i - 25)
        want = (None, None) if i in (1, 40) or not n else (least, n)
        assert found[i] == want, i
    again = index.insert(gone)
    assert again.table.count() == 46
