from __future__ import annotations

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from tallyrate.llm import token_alignment, tokens
from tests.llm.fixtures import ODD_TEXTS, documents, random_text

A, B = tokens.public_path("byte_bpe_50k.json"), tokens.public_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(text, libraries):
    """(id, start, end) of all tokens, by the libraries on the whole text."""
    a, b = libraries
    whole = (" " + (text or "")).encode()
    if not text:
        return [], []
    letter = token_alignment.byte_level_alphabet()
    out = []
    for tokens_of in ([(i, bytes(letter[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
                      [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                       for i in b.encode(text)]):
        if b"".join(x for _, x in tokens_of) != whole:
            return [], []
        at, own = 0, []
        for i, x in tokens_of:
            own.append((i, at, at + len(x)))
            at += len(x)
        out.append(own)
    return out


def brute_force(texts, libraries):
    groups = []
    for text in texts:
        a, b = spans(text, libraries)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        own, begin = [], 0
        for cut in cuts:
            own.append(([i for i, s, e in a if begin <= s and e <= cut], [i for i, s, e in b if begin <= s and e <= cut]))
            begin = cut
        groups.append(own)
    counts = Counter(pair for own in groups for pair in {(x, y) for g in own for x in g[0] for y in g[1]})
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    rows = []
    for own in groups:
        links = [(x, y) for g in own for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in own)
        rows.append((sum(len(g[0]) for g in own), sum(len(g[1]) for g in own), len(own), len(links),
                     sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links),
                     sha256(text.encode()).hexdigest() if own else ""))
    return rows


def values(rows):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
            for r in sorted(rows, key=lambda r: r.doc_id)]


def texts():
    rng = random.Random(5)
    odd = ["a▁b ▁ c", "▁", "x ▁ y", "a  b   c", " lead", "trail  ", "\nnew line", "a \n b", "日本語 テキスト", "🎉🎉 👩‍👩‍👧", "=" * 500,
           "<s> </s> <unk> <0x41>", "nul\x00byte", "ﬁne é é", " nbsp  x", "no" * 300, "\t tab", "a 　b"]
    return [random_text(rng, rng.randrange(1, 60)) for _ in range(50)] + odd + ODD_TEXTS + ["the same text"] * 30


def test_align_equals_brute_force(spark, libraries):
    given = texts()
    found = token_alignment.align(documents(spark, given), A, B).collect()
    assert values(found) == brute_force(given, libraries)


def test_many_fragments_and_parts(spark, libraries, monkeypatch):
    monkeypatch.setattr(token_alignment, "PAIRS", 97)
    monkeypatch.setattr(token_alignment, "LOOKUPS", 50)
    monkeypatch.setattr(token_alignment, "DEALT", 7)
    given = texts()[::3]
    assert values(token_alignment.align(documents(spark, given), A, B).collect()) == brute_force(given, libraries)


def test_pieces_join_to_the_text_and_need_no_whole_encoding(libraries):
    a, b = libraries
    found = token_alignment.Aligned(token_alignment.Side(A), token_alignment.Side(B))
    assert token_alignment.safe_cuts(found)
    for text in filter(None, texts()):
        own = token_alignment.pieces(text)
        assert " ".join(own) == text
        if "▁" not in text:
            assert [i for p in own for i in b.encode(p)] == b.encode(text)
        assert [i for p in own for i in a.encode(" " + p, add_special_tokens=False).ids] == a.encode(
            " " + text, add_special_tokens=False).ids


def test_small_expansions_and_forgetting_change_nothing(monkeypatch):
    given = texts()
    def run():
        found = token_alignment.Aligned(token_alignment.Side(A), token_alignment.Side(B))
        out = [token_alignment.align_texts(found, given[i:i + 9]) for i in range(0, len(given), 9)]
        return [[x.tolist() if isinstance(x, np.ndarray) else x for x in part] for part in out]
    want = run()
    monkeypatch.setattr(token_alignment, "EXPANDED", 3)
    monkeypatch.setattr(token_alignment, "HELD", 10)
    monkeypatch.setattr(token_alignment, "JOINED", 5)
    assert run() == want


def test_groups_where_tokens_cross():
    a, b, starts = token_alignment.coalesce(np.array([2, 2, 1, 3]), np.array([1, 3, 1, 1, 2]))
    assert a.tolist() == [0, 0, 1, 2] and b.tolist() == [0, 0, 1, 2, 2] and starts.tolist() == [0, 4, 5]


def test_no_rows_null_ids_and_equal_rows(spark, libraries):
    frame = spark.createDataFrame([(None, "one text"), (None, "one text"), (3, None)], "doc_id long, text string")
    found = token_alignment.align(frame, A, B).collect()
    want = brute_force(["one text", "one text", None], libraries)
    assert sorted(r.count_sum for r in found) == sorted(w[5] for w in want)
    assert token_alignment.align(frame.limit(0), A, B).count() == 0
