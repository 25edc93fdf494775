from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tallyrate.llm import mixing
from tests.llm.fixtures import ODD_TEXTS, documents, random_text


def water_filled(sizes, weights, most):
    """Shares by weight; what exceeds a source's limit is shared again until none does."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, open_, out = float(sum(sizes.values())), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def mixed(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr(
        "*", "1 as size", "2 as hash", "3 as target", "4 as whole")
    return mixing.mix(frame).collect()


def check(rows, found):
    sizes, own = Counter(), Counter()
    for _, source, text in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
    assert len(found) == len(rows)
    want = water_filled(sizes, mixing.WEIGHTS, mixing.MAX_REPEATS)
    longest = {s: max([r.size for r in found if r.source == s]) for s in sizes}
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size <= 3 * r.size
        own[r.source] += r.taken
    for s in sizes:
        assert abs(own[s] - want[s]) <= longest[s], s


def test_targets_and_words_taken(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 8 + ["a", "b", "é", "Z", None]), random_text(rng, rng.randrange(60)))
            for i in range(400)]
    rows += [(500 + i, "b", text) for i, text in enumerate(ODD_TEXTS)] + [(600, "tiny", "two words"), (601, "empty", "")]
    found = mixed(spark, rows)
    check(rows, found)
    again = mixed(spark, rows[::-1])
    assert sorted((r.doc_id, r.taken) for r in found) == sorted((r.doc_id, r.taken) for r in again)


def test_a_source_may_be_above_its_share_or_stop_at_its_limit(spark):
    rows = [(i, "a", "w " * 3) for i in range(10)] + [(50 + i, "b", "w " * 30) for i in range(40)] + [(99, "c", "w")]
    found = mixed(spark, rows)
    check(rows, found)
    assert {r.copies for r in found if r.source == "a"} == {3} and {r.copies for r in found if r.source == "c"} == {3}


def test_rows_without_id_are_told_apart_by_text_and_ties_go_together(spark):
    rows = [(None, "a", f"text {i} " * (i % 9 + 1)) for i in range(200)] + [(7, "b", "same words here")] * 5
    rows += [(300 + i, "b", "other words " * 6) for i in range(60)]
    found = mixed(spark, rows)
    check(rows, found)
    assert len({r.copies for r in found if r.doc_id == 7}) == 1
    assert len({r.copies for r in found if r.doc_id is None}) == 2


def test_thresholds_are_nested(spark):
    rng = random.Random(9)
    frame = documents(spark, [random_text(rng, 30) for _ in range(300)])
    sized = mixing.sized_rows(frame).selectExpr("id", "'s' as source", "size", "hash").cache()
    total = sized.agg({"size": "sum"}).first()[0]
    taken = []
    for share in (0.1, 0.35, 0.8):
        wanted = spark.createDataFrame([("s", total, share * total)], "source string, source_size long, target double")
        limit = mixing.thresholds(sized, wanted).first().limit
        taken.append({r.id for r in sized.where(sized.hash < limit).collect()})
        words = sized.where(sized.hash < limit).agg({"size": "sum"}).first()[0]
        assert abs(words - share * total) <= 60
    assert taken[0] < taken[1] < taken[2]


def test_mixed_rows_repeat_whole_rows(spark):
    rng = random.Random(4)
    docs = documents(spark, [random_text(rng, 20) for _ in range(60)] + ODD_TEXTS)
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    counted = Counter(r.doc_id for r in out.collect())
    assert counted == Counter({i: n for i, n in copies.items() if n})


def test_no_documents_and_no_words(spark):
    assert mixed(spark, []) == []
    assert mixing.mixed_rows(documents(spark, []).limit(0)).count() == 0
    assert [(r.target, r.taken) for r in mixed(spark, [(1, "a", None), (2, None, " ")])] == [(0.0, 0), (0.0, 0)]


def test_native_plan(spark):
    docs = documents(spark, ["one two", "three"])
    for frame in (mixing.mix(docs), mixing.mixed_rows(docs), mixing.sized_rows(docs)):
        assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [None, 7])
def test_a_group_of_one_key_is_split_at_the_threshold(spark, key):
    """A third of the hot source has one key and one text; other groups have one key and many texts."""
    rows = [(100 + i, "c", f"{i} " + "w " * 9) for i in range(2000)] + [(key, "c", "same " * 10)] * 1000
    rows += [(5000 + i, "a", "x " * 25) for i in range(600)] + [(6000 + i % 2, "b", f"{i} " + "y " * (i % 30)) for i in range(500)]
    found = mixed(spark, rows)
    check(rows, found)
    assert sum(r.taken for r in found if r.source == "c") == pytest.approx(found[0].target if found[0].source == "c" else next(
        r.target for r in found if r.source == "c"), abs=10)
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = Counter(r.source for r in mixing.mixed_rows(frame).collect())
    assert out == Counter({s: sum(r.copies for r in found if r.source == s) for s in "abc"})
    assert sorted((str(r.doc_id), r.taken) for r in found) == sorted((str(r.doc_id), r.taken) for r in mixed(spark, rows[::-1]))
