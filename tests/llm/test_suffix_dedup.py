from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tallyrate.llm import suffix_array, suffix_dedup
from tests.llm.fixtures import ODD_TEXTS, documents, random_text


@pytest.mark.parametrize("small", [1, 2048])
def test_suffix_array_and_prefixes(monkeypatch, small):
    monkeypatch.setattr(suffix_array, "SMALL_ALPHABET", small)
    rng = random.Random(4)
    texts = [[rng.randrange(k) for _ in range(n)] for k in (1, 2, 3, 26, 4000) for n in (0, 1, 2, 3, 5, 20, 150)]
    texts += [[1, 2] * 60, [0] * 30 + [1] + [0] * 30, list(range(300)), list(range(300, 0, -1))]
    for text in texts:
        order = suffix_array.suffix_array(np.array(text, np.int64))
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == want
        for cap in (3, 200):
            found = suffix_array.permuted_prefixes(np.array(text, np.int64), order, cap, lane=7)
            for a, b in zip(want, want[1:]):
                same = 0
                while same < min(len(text) - max(a, b), cap) and text[a + same] == text[b + same]:
                    same += 1
                assert found[b] == same


def brute_force(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        yield len(d), suffix_dedup._intervals(gone), np.frombuffer(d, np.uint8)[~gone].tobytes()


@pytest.mark.parametrize("most", [1, 4096])
@pytest.mark.parametrize("length", [40, 200])
def test_removal_matches_brute_force(spark, length, most):
    rng = random.Random(8)
    passages = [random_text(rng, n)[:m] for n, m in ((60, 199), (60, 200), (80, 201), (90, 320), (300, 1500))]
    texts = list(ODD_TEXTS)
    for i in range(60):
        inner = rng.choice([*passages, ""])
        texts.append(random_text(rng, rng.randrange(60)) + inner + random_text(rng, rng.randrange(40)))
    texts += [texts[20]] * 3 + [texts[30], passages[4] + passages[4], "ab" * 400, "a" * 700, "\0" * 300 + "x" + "\0" * 250]
    texts += [passages[4][:k] for k in (150, 230, 700)]
    found = suffix_dedup.remove_repeats(documents(spark, texts), length=length, most=most).collect()
    assert len(found) == len(texts)
    want = list(brute_force(texts, length))
    for row in found:
        size, spans, kept = want[row.doc_id]
        assert row.n_bytes == size
        assert [(s.start, s.end - 1) for s in row.spans] == spans, row.doc_id
        assert hashlib.sha256(row.kept).digest() == hashlib.sha256(kept).digest()
    assert sum(bool(s) for _, s, _ in want) > 20


def test_texts_longer_than_a_span(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SPAN", 700)
    rng = np.random.default_rng(1)
    data = rng.integers(97, 110, 5000).astype(np.uint8)
    data[4000:4400] = data[1000:1400]
    ends = np.array([2600, 2700, 5000])
    covered = []
    for starts, counts, _ in suffix_dedup.stretches(data, ends, 200):
        covered += [i for s, n in zip(starts.tolist(), counts.tolist()) for i in range(s, s + n)]
    begins = [0, 2600, 2700]
    assert sorted(covered) == [i for b, e in zip(begins, ends) for i in range(b, e - 199)]


def test_no_documents(spark):
    assert suffix_dedup.remove_repeats(documents(spark, []).limit(0)).count() == 0
    rows = spark.createDataFrame([(None, None), (1, "x" * 300), (1, "x" * 300)], "doc_id long, text string")
    assert sorted((r.n_bytes, len(r.kept)) for r in suffix_dedup.remove_repeats(rows).collect()) == [(0, 0), (300, 0), (300, 0)]
