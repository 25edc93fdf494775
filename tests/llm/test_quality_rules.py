from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tallyrate.llm import quality_rules
from tallyrate.llm.quality_rules import BASE, POLICIES, PROSE, PROSE_1, RULES, Policy
from tests.llm.fixtures import ODD_TEXTS, documents, random_text

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def measures(text):
    words = [w for w in SPACE.split(text or "") if w]
    lines = [x for x in (text or "").split("\n") if SPACE.sub("", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    return dict(
        n_words=len(words), word_chars=sum(map(len, words)), n_symbols=sum(c in "#*$%&|<>" for c in text or ""),
        n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(covered), n_lines=len(lines),
        n_capitals=sum("A" <= c <= "Z" for c in text or ""),
        n_bullets=sum(SPACE.sub("", x)[0] in "-*•" for x in lines),
        n_ellipses=sum(SPACE.sub("", x).endswith(("...", "…")) for x in lines),
        n_letter_words=sum(any(c.isalpha() for c in w) for w in words))


def failures(m):
    return sum(1 << i for i, rule in enumerate(RULES)
               if eval(rule.broken.replace("AND", "and"), {}, m))  # the same words mean the same here


def texts():
    rng = random.Random(11)
    out = [random_text(rng, rng.randrange(200)) for _ in range(40)]
    out += ["x " * 30, "a b c d e " * 2, "a b c d e f a b c d e", "a b c d " * 5, "one two three four five six " + "w" * 500,
            "same line here\n" * 9, "- item\n* item\n• item\n" * 4, "what...\nso… \n" * 6, "### $$$ a b c d e f g h",
            "ALL CAPS TEXT " * 8, "1 2 3 4 5 6 7 8 9 10 11 12 a", "tab\tonly\x0bvertical\x0cform\r\nreturn", "a\n\n \nb\n a\na"]
    return out + ODD_TEXTS + [" ".join(f"w{i}" for i in range(30_000)) + " w0 w1 w2 w3 w4"]


def test_measures_and_bits_equal_brute_force(spark):
    given = texts()
    found = quality_rules.ledger(documents(spark, given)).collect()
    assert len(found) == len(given)
    for row in found:
        want = measures(given[row.doc_id])
        assert {k: row[k] for k in quality_rules.MEASURES} == want, given[row.doc_id]
        assert row.failures == failures(want)


def test_repeated_rows_null_ids_and_no_rows(spark):
    frame = spark.createDataFrame([(None, "a b"), (7, None), (7, None), (7, "x")], "doc_id long, text string")
    found = quality_rules.ledger(frame).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in found) == [("7", 0), ("7", 0), ("7", 1), ("None", 2)]
    none = quality_rules.ledger(frame.limit(0))
    assert none.count() == 0
    assert {(r.n_documents, r.n_kept, r.n_broken, r.n_alone)
            for r in quality_rules.ablations(none).collect()} == {(0, 0, 0, 0)}


def test_policies_and_ablations(spark):
    given = texts()
    entries = quality_rules.ledger(documents(spark, given)).cache()
    bits = {r.doc_id: r.failures for r in entries.collect()}
    names = [rule.name for rule in RULES]
    for policy in POLICIES:
        kept = {r.doc_id for r in quality_rules.verdicts(entries, policy).where("kept").collect()}
        assert kept == {i for i, b in bits.items() if not any(b >> names.index(r) & 1 for r in policy.rules)}
    rows = {(r.policy, r.version, r.rule): r for r in quality_rules.ablations(entries).collect()}
    assert len(rows) == sum(len(p.rules) for p in POLICIES)
    for policy in POLICIES:
        for rule in policy.rules:
            less = Policy(policy.name, policy.version, tuple(r for r in policy.rules if r != rule))
            row = rows[policy.name, policy.version, rule]
            assert row.n_documents == len(given)
            assert row.n_kept + row.n_alone == sum(b & less.mask == 0 for b in bits.values())
            assert row.n_broken == sum(b >> names.index(rule) & 1 for b in bits.values())


def test_a_later_version_holds_the_earlier_one():
    assert PROSE.mask & PROSE_1.mask == PROSE_1.mask and PROSE_1.mask & BASE.mask == BASE.mask
    with pytest.raises(ValueError):
        Policy("unknown", 1, ("no_such_rule",)).mask


def test_native_plan(spark):
    entries = quality_rules.ledger(documents(spark, ["one two", "three"]))
    for frame in (entries, quality_rules.verdicts(entries, PROSE), quality_rules.ablations(entries)):
        assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
