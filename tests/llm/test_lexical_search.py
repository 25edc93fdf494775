from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tallyrate.llm import lexical_search
from tests.llm.fixtures import ODD_TEXTS, documents, random_text

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def cut(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, k=10):
    own = [(i, Counter(cut(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in own:
            m = 25 + 75 * sum(c.values()) * n // total if total else 25
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t in cut(text) if t in c)
            found.append((-score, (i is None, i or 0), i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(x for x in found if x[0] < 0)[:k])]
    return out


def tables(seed=2, n=300):
    rng = random.Random(seed)
    texts = [random_text(rng, rng.choice([3, 10, 10, 10, 40, 200])) for _ in range(n)] + ODD_TEXTS
    texts += ["the same common line of words"] * 60 + ["rare " * 50 + "word", "Rare RARE rare"]
    items = ["the common line", "rare word rare", "of of of the and", "", None, "nothing-like-this zzz", "42 3.14 über ÜBER", "the"]
    return texts, items + [random_text(rng, 12) for _ in range(20)]


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(items)], "item_id long, text string, row int, term string")


def rows(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def test_rank_equals_brute_force(spark):
    texts, items = tables()
    found = lexical_search.rank(documents(spark, texts), items_frame(spark, items))
    assert rows(found) == sorted(brute_force(list(enumerate(texts)), list(enumerate(items))))


@pytest.mark.parametrize("shard, block", [(40, 3), (7, 1000), (10_000, 2)])
def test_any_shards_and_blocks_give_the_same(spark, shard, block):
    texts, items = tables(4, 120)
    asked = lexical_search.item_terms(items_frame(spark, items))
    index = lexical_search.build_index(documents(spark, texts), asked.select("term").distinct(), shard=shard)
    assert rows(lexical_search.search(index, asked, 5, block)) == sorted(
        brute_force(list(enumerate(texts)), list(enumerate(items)), 5))


def test_an_index_of_all_terms_serves_any_items(spark):
    texts, items = tables(6, 60)
    index = lexical_search.build_index(documents(spark, texts), shard=500)
    for asked in (items[:3], items[3:]):
        assert rows(lexical_search.search(index, lexical_search.item_terms(items_frame(spark, asked)))) == sorted(
            brute_force(list(enumerate(texts)), list(enumerate(asked))))


def test_ties_repeated_and_null_ids(spark):
    docs = [(9, "tie word"), (None, "tie word"), (3, "tie word"), (3, "tie word"), (5, "other thing"), (6, "more and more")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = lexical_search.rank(frame, items_frame(spark, ["tie"])).orderBy("rank").collect()
    assert [r.doc_id for r in found] == [3, 3, 9, None] and len({r.score for r in found}) == 1


def test_a_common_length_and_term_is_dealt_over_shards(spark):
    texts = [f"common {i} filler" for i in range(400)] + ["common"]
    asked = lexical_search.item_terms(items_frame(spark, ["common"]))
    index = lexical_search.build_index(documents(spark, texts), asked.select("term").distinct(), shard=50)
    shards = index.postings.selectExpr("shard", "size(docs) as n").groupBy("shard").sum("n").collect()
    assert len(shards) >= 8 and max(r["sum(n)"] for r in shards) < 120
    assert rows(lexical_search.search(index, asked)) == sorted(brute_force(list(enumerate(texts)), [(0, "common")]))


def test_no_documents_or_items(spark):
    texts, items = tables(1, 5)
    docs = documents(spark, texts)
    assert lexical_search.rank(docs.limit(0), items_frame(spark, items)).count() == 0
    assert lexical_search.rank(docs, items_frame(spark, items).limit(0)).count() == 0
    assert lexical_search.rank(documents(spark, [None, "", "!!"]), items_frame(spark, items)).count() == 0
