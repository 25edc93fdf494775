"""URL filter: host and path rules first, then a weighted vocabulary.

A rule names a host and a path prefix; it fits its host and all subdomains, and the most
specific rule wins. Where none fits, an Aho-Corasick automaton finds the vocabulary's terms in
host and path in one pass; a term counts where no letter or digit touches it. One strict term
or several distinct soft ones reject the address.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrate.llm import common
from tallyrate.llm.url_terms import SOFT, STRICT

SOFT_LIMIT = 2

ALLOW, BLOCK = "allow", "block"

_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Rule:
    """`target` is host and path prefix in one, such as `example.net/en/`."""

    verdict: str
    target: str

    @property
    def host(self) -> str:
        return self.target.partition("/")[0]

    @property
    def path(self) -> str:
        return self.target[len(self.host):]


def host_of(url: Column) -> Column:
    """From the first `://` to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(target, verdict) of the longest rule that fits, by host and then by path; null if none."""
    target = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host), len(r.path))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        target = F.when(fits, rule.target).otherwise(target)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return target, verdict


@lru_cache(maxsize=8)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term in (*soft, *strict):  # a term in both lists is strict
        found.add_word(term, (term, term in strict))
    found.make_automaton()
    return found


def term_counts(address: str, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[int, int]:
    """Distinct strict and soft terms that stand alone between characters other than ASCII
    letters and digits."""
    text = address.translate(_ASCII_LOWER)
    hits: tuple[set, set] = (set(), set())
    for end, (term, is_strict) in _automaton(strict, soft).iter(text):
        start = end - len(term) + 1
        if not (start and _joins(text[start - 1])) and not (end + 1 < len(text) and _joins(text[end + 1])):
            hits[0 if is_strict else 1].add(term)
    return len(hits[0]), len(hits[1])


def _joins(character: str) -> bool:
    return character.isascii() and character.isalnum()


def judge(pages: DataFrame, rules: Sequence[Rule], id_column: str = "page_id", url: str = "url",
          strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, soft_limit: int = SOFT_LIMIT,
          ) -> DataFrame:
    """One row per page: id, host, path, rule, strict_terms, soft_terms, verdict.

    A null url or one without `://` has empty host and path; no rule fits it and it is allowed.
    Vocabulary terms are lower-case ASCII. Repeated rows each have their row. Other columns of
    `pages` are not read.
    """
    rows = common.columns_of(pages, id=id_column, url=url).select(
        "id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    schema = T.StructType([*rows.schema.fields, T.StructField("strict_terms", T.IntegerType()),
                           T.StructField("soft_terms", T.IntegerType())])
    terms = tuple(strict), tuple(soft)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [term_counts(host + path, *terms) for host, path in zip(
                batch.column("host").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([a for a, _ in counts], pa.int32()),
                 pa.array([b for _, b in counts], pa.int32())], names=[f.name for f in schema])

    counted = common.map_batches(rows, of_batches, schema)
    target, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    by_terms = F.when((F.col("strict_terms") > 0) | (F.col("soft_terms") >= soft_limit), BLOCK).otherwise(ALLOW)
    return counted.select(F.col("id").alias(id_column), "host", "path", target.alias("rule"),
                          "strict_terms", "soft_terms", F.coalesce(verdict, by_terms).alias("verdict"))
