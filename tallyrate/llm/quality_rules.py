"""Quality rules as a bitmask ledger, with DataFrame operations only.

Every rule is evaluated once for each document. The ledger keeps what was measured and one bit
for each rule that the document breaks. A policy is a versioned set of rules, that is a mask:
verdicts and ablations of any policy come from the bits alone and read no text again.

Null and empty texts have no words and break `few_words`. Repeated rows each have their row.
Only the named columns are read, so other columns of any name change nothing. Very long texts
are measured whole; a text's windows are sorted within its row, not compared pairwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrate.llm import common

# Words in a window whose repetition counts.
WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
BULLET = "^[\\x20\\x09-\\x0D]*[-*\\u2022]"
ELLIPSIS = "(\\.\\.\\.|\\u2026)[\\x20\\x09-\\x0D]*$"


@dataclass(frozen=True)
class Rule:
    """`broken` is a condition over the measurements, in SQL that any engine reads."""
    name: str
    broken: str


# A rule's place is its bit in every stored ledger: append, never reorder.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("many_words", "n_words > 100000"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("capitals", "2 * n_capitals > word_chars"),
    Rule("repeated_lines", "n_lines >= 5 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule("bullets", "n_lines >= 5 AND 10 * n_bullets > 9 * n_lines"),
    Rule("ellipses", "n_lines >= 5 AND 10 * n_ellipses > 3 * n_lines"),
    Rule("few_letters", "10 * n_letter_words < 8 * n_words"),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
            "n_bullets", "n_ellipses", "n_letter_words")


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [rule.name for rule in RULES]
        return sum(1 << names.index(rule) for rule in dict.fromkeys(self.rules))


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
PROSE_1 = Policy("prose", 1, (*BASE.rules, "many_words", "short_words", "long_words", "symbols", "repeated_lines",
                              "bullets", "ellipses"))
PROSE = Policy("prose", 2, (*PROSE_1.rules, "capitals", "few_letters"))
POLICIES = (BASE, PROSE_1, PROSE)


def _number(column: Column) -> Column:
    return column.cast("long")


def _covered(starts: Column) -> Column:
    """How many places lie in the windows at these ascending starts."""
    empty = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(starts, empty, lambda had, at: F.struct(
        at.alias("last"), (had["n"] + F.least(F.lit(WINDOW), at - had["last"])).alias("n")), lambda had: had["n"])


def measured(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id and MEASURES.

    Windows are told apart by 64-bit hashes of their words. Only texts in which two hashes agree
    have their windows sorted, by hash and place; places next to an equal hash are covered.
    """
    rows = common.columns_of(docs, id=id_column, text=text).select("id", F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(common.WORD))
    cut = rows.select("id", "text", F.regexp_extract_all("text", F.lit(common.WORD), F.lit(0)).alias("words"),
                      lines.alias("lines"))
    last = F.size("words") - WINDOW
    window = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda at: F.xxhash64(
        *(F.get(F.col("words"), at + i) for i in range(WINDOW)))))
    hashed = cut.select("*", F.coalesce(window, F.array().cast("array<long>")).alias("windows"))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.select("*", F.when(twice, F.sort_array(F.transform(
        "windows", lambda h, at: F.struct(h.alias("h"), at.alias("at"))))).alias("ordered")).drop("windows")
    near = F.filter("ordered", lambda x, i: (x["h"] == F.get(F.col("ordered"), i - 1)["h"])
                    | (x["h"] == F.get(F.col("ordered"), i + 1)["h"]))
    repeats = ordered.select("*", F.sort_array(F.transform(near, lambda x: x["at"])).alias("repeats")).drop("ordered")
    return repeats.select(
        "id", _number(F.size("words")).alias("n_words"), _number(F.length(F.concat_ws("", "words"))).alias("word_chars"),
        _number(F.regexp_count("text", F.lit(SYMBOLS))).alias("n_symbols"),
        _number(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _number(F.coalesce(_covered(F.col("repeats")), F.lit(0))).alias("n_repeat_words"),
        _number(F.size("lines")).alias("n_lines"), _number(F.regexp_count("text", F.lit("[A-Z]"))).alias("n_capitals"),
        _number(F.size(F.filter("lines", lambda x: x.rlike(BULLET)))).alias("n_bullets"),
        _number(F.size(F.filter("lines", lambda x: x.rlike(ELLIPSIS)))).alias("n_ellipses"),
        _number(F.size(F.filter("words", lambda x: x.rlike("\\p{L}")))).alias("n_letter_words"))


def with_failures(measures: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds `failures`: bit i is set where rule i is broken."""
    bits = (F.when(F.expr(rule.broken), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
            for i, rule in enumerate(rules))
    return measures.withColumn("failures", reduce(lambda a, b: a.bitwiseOR(b), bits))


def ledger(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, MEASURES, `failures`. To be written once and read by every
    policy."""
    return with_failures(measured(docs, id_column, text)).withColumnRenamed("id", id_column)


def passes(policy: Policy, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(policy.mask)) == 0


def verdicts(entries: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with policy, version and `kept`."""
    return entries.withColumns({"policy": F.lit(policy.name), "version": F.lit(policy.version), "kept": passes(policy)})


def ablations(entries: DataFrame, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """policy, version, rule, n_documents, n_kept, n_broken, n_alone: how many documents there
    are, the policy keeps, break the rule, and break it alone, so that the policy without the
    rule would keep them. An empty ledger gives zeros.

    The ledger is first counted by its bits, of which there are few different ones.
    """
    counted = entries.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    names = [rule.name for rule in RULES]

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    found = [F.struct(
        F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(rule).alias("rule"),
        total(F.lit(True)).alias("n_documents"), total(passes(p)).alias("n_kept"),
        total(F.getbit("failures", F.lit(names.index(rule))) == 1).alias("n_broken"),
        total(F.col("failures").bitwiseAND(F.lit(p.mask)) == (1 << names.index(rule))).alias("n_alone"))
        for p in policies for rule in dict.fromkeys(p.rules)]
    return counted.agg(F.array(*found).alias("found")).select(F.explode("found").alias("row")).select("row.*")
