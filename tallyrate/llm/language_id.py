"""Language identification by Bayesian fusion of text, declared language and host evidence.

The text gives a likelihood per language from byte trigrams. The language that the markup
declares has a likelihood per language, and the host a prior, both counted over all rows by
grouped aggregation. Host priors are smoothed in levels: a host leans on its domain, a domain on
its address suffix, a suffix on the whole corpus. Rows are decided by the product of the three.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyrate.llm import common
from tallyrate.storage import written_table

UNKNOWN = "und"

# Different labelled texts of each language that the trigram model is fitted on, at most; the
# only part that is bounded.
FIT_ROWS = 4000
TRIGRAMS = 1 << 16
# Weight of a uniform distribution in each language's trigrams.
FLOOR = 0.1
# Neighbouring trigrams say partly the same: their log-likelihood counts by this factor.
TEMPER = 0.25
# Rows that the coarser level counts for in a finer level's prior, and as many declarations.
SMOOTHING = 20.0
UNKNOWN_PRIOR = 1e-3

_LETTER = re.compile(r"[^\W\d_]")
_HIDING = re.compile(r"<!--|<(?:script|style)\b", re.I)
_ENDS = {"<!--": re.compile("-->"), "<script": re.compile(r"</script\s*>", re.I), "<style": re.compile(r"</style\s*>", re.I)}
_HTML = re.compile(r"<html(?=[\s/>])", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_CODE = re.compile("[a-z]{2,3}", re.I)


def trigram_places(text: str, size: int = 1 << 20) -> Iterator[np.ndarray]:
    """Places of all byte trigrams of the lower-cased text, in pieces."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    for at in range(0, max(0, len(data) - 2), size):
        part = data[at:at + size + 2].astype(np.uint32)
        yield ((part[:-2] << 11) ^ (part[1:-1] << 5) ^ part[2:]) & (TRIGRAMS - 1)


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities of trigrams; the last column is the unknown language's."""

    languages: tuple[str, ...]
    logs: np.ndarray

    def evidence(self, text: str | None) -> list[float] | None:
        """Tempered log-likelihood per language; None for a text without letters."""
        if not text or not _LETTER.search(text):
            return None
        total = np.zeros(self.logs.shape[1])
        for places in trigram_places(text):
            total += np.bincount(places, minlength=TRIGRAMS) @ self.logs if len(places) > TRIGRAMS \
                else self.logs[places].sum(axis=0, dtype=np.float64)
        return (TEMPER * total).tolist()


def fit(labelled: DataFrame, text: str = "text", language: str = "lang",
        rows: int = FIT_ROWS) -> TextModel:
    """Trigram model of at most `rows` different texts of each language, those with the lowest
    hashes; copies count once and no label is left out. Rows without text or label do not count;
    without any labelled row every text is of unknown language."""
    known = common.columns_of(labelled, text=text, lang=language).where(
        "text is not null and lang is not null").withColumn("_h", F.xxhash64("lang", "text"))
    hashes = written_table(known.select("lang", "_h").distinct(), "text-hashes")
    sizes = written_table(hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")), "label-sizes")
    # About twice as many as needed are ranked, so no language's hashes meet in one place.
    share = F.least(F.lit(1.0), F.lit(2.0 * rows) / F.col("_n"))
    low = hashes.join(sizes, "lang").where(
        (share == 1.0) | (F.col("_h") <= (share * (2.0**64 - 2.0**12) - 2.0**63).cast("long")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h"))
    limits = written_table(low.withColumn("_rank", rank).where(F.col("_rank") <= rows).groupBy("lang").agg(
        F.max("_h").alias("_limit")), "fit-limits")
    drawn = known.join(limits, "lang").where("_h <= _limit").groupBy("lang", "_h").agg(F.min("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                own = found.setdefault(lang, np.zeros(TRIGRAMS, np.int64))
                for places in trigram_places(text):
                    own += np.bincount(places, minlength=TRIGRAMS)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(list(found), pa.string()),
            "counts": pa.array([x.tobytes() for x in found.values()], pa.binary())})

    counts: dict[str, np.ndarray] = {}
    for row in common.map_batches(drawn.select("text", "lang"), count, "lang string, counts binary").toLocalIterator():
        counts[row.lang] = counts.get(row.lang, 0) + np.frombuffer(row.counts, np.int64)
    languages = tuple(sorted(counts))
    columns = [np.log((1 - FLOOR) * counts[x] / max(1, counts[x].sum()) + FLOOR / TRIGRAMS)
               for x in languages]
    columns.append(np.full(TRIGRAMS, -np.log(TRIGRAMS)))
    return TextModel(languages, np.stack(columns, axis=1).astype(np.float32))


def _with_evidence(rows: DataFrame, text: str, model: TextModel) -> DataFrame:
    """`rows`, whose names differ, with `_logs`; a few megabytes of text at a time."""
    schema = T.StructType([*rows.schema.fields, T.StructField("_logs", T.ArrayType(T.DoubleType()))])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.byte_sized(batches, text):
            logs = pa.array([model.evidence(x) for x in batch.column(text).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, logs], names=schema.names)

    return common.map_batches(rows, of_batches, schema)


def _normal(logs: Column) -> Column:
    """Probabilities in proportion to the exponentials of `logs`."""
    shares = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shares, lambda x: x / F.aggregate(shares, F.lit(0.0), lambda a, b: a + b))


def _sums(values: str, size: int) -> Column:
    return F.array(*(F.sum(F.get(values, F.lit(i))) for i in range(size)))


def _leaning(counts: Column, above: Column) -> Column:
    """Shares of `counts`, with `SMOOTHING` rows dealt out like `above`."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b) + SMOOTHING
    return F.zip_with(counts, above, lambda n, p: (n + SMOOTHING * p) / total)


def identify(rows: DataFrame, model: TextModel, text: str, declared: str,
             levels: Sequence[str]) -> DataFrame:
    """`rows` with `language`, `probability` and `text_language` added.

    `levels` are the host columns from coarse to fine. A text that is null, empty or without
    letters is of unknown language (`und`) with probability 1 and takes no part in the counts.
    A null declaration or host is a value of its own. Repeated rows count each. Columns of
    `rows` that have the added names are left out.
    """
    named = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    flat = rows.toDF(*named.values()).withColumn(named[text], F.col(named[text]).cast("string"))
    needed = list(dict.fromkeys(named[c] for c in (text, declared, *levels)))
    keys = named[declared], [named[c] for c in levels]
    carried = {named[c]: c for c in rows.columns if c not in ADDED}
    return _decided(_keyed(_with_evidence(flat.select(*needed), named[text], model), *keys),
                    _keyed(_with_evidence(flat, named[text], model), *keys, carried), model, len(levels))


ADDED = ("language", "probability", "text_language")


def _keyed(rows: DataFrame, declared: str, levels: Sequence[str],
           carried: Mapping[str, str] | None = None) -> DataFrame:
    """The evidence under fixed names, with the carried columns, renamed, as `_row`."""
    row = [F.struct(*(F.col(c).alias(name) for c, name in carried.items())).alias("_row")] if carried else []
    return rows.select(
        *row, F.coalesce(F.lower(F.col(declared).cast("string")), F.lit("")).alias("_declared"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_level{i}") for i, c in enumerate(levels)), "_logs")


def _decided(narrow: DataFrame, scored: DataFrame, model: TextModel, depth: int) -> DataFrame:
    """Decide the rows of `scored` by the evidence of `narrow`, the same rows without `_row`."""
    names = (*model.languages, UNKNOWN)
    size = len(names)
    keys = [f"_level{i}" for i in range(depth)]
    known = written_table(narrow.where("_logs is not null").select(
        "_declared", *keys, _normal(F.col("_logs")).alias("_p")), "text-evidence")

    # P(l) over the whole corpus, then one level after the other.
    total = known.groupBy("_declared", *keys).agg(_sums("_p", size).alias("_n"))
    total = written_table(total, "evidence-counts")
    corpus = total.agg(_sums("_n", size).alias("n")).first()
    counted = np.array([x or 0.0 for x in (corpus.n or [0.0] * size)])
    prior = (counted + 1.0 / size) / (counted.sum() + 1.0)
    prior = np.append(prior[:-1] / max(prior[:-1].sum(), 1e-300) * (1 - UNKNOWN_PRIOR), UNKNOWN_PRIOR) \
        if size > 1 else np.ones(1)
    above = F.array(*(F.lit(float(p)) for p in prior))
    table = None
    for depth in range(len(keys)):
        own = total.groupBy(*keys[:depth + 1]).agg(_sums("_n", size).alias("_own"))
        if table is not None:
            own = own.join(table, keys[:depth])
        table = written_table(own.select(*keys[:depth + 1], _leaning(
            F.col("_own"), F.col("_prior") if table is not None else above).alias("_prior")), "host-priors")
    said = total.groupBy("_declared").agg(_sums("_n", size).alias("_own"))
    everyone = F.array(*(F.lit(float(n)) for n in counted))
    # A declaration seen with no text of language l still has the share that all rows give it.
    said = written_table(said.select("_declared", F.zip_with("_own", everyone, lambda n, all_of: (
        n + SMOOTHING * F.aggregate("_own", F.lit(0.0), lambda a, b: a + b) / F.lit(float(counted.sum() or 1.0)))
        / (all_of + SMOOTHING)).alias("_said")), "declarations")

    fused = scored.join(said, "_declared", "left")
    if table is not None:
        fused = fused.join(table, keys, "left")
    else:
        fused = fused.withColumn("_prior", above)
    logs = F.zip_with(F.zip_with("_logs", F.coalesce("_prior", above), lambda x, p: x + F.log(p)),
                      F.coalesce("_said", F.array_repeat(F.lit(1.0), size)), lambda x, p: x + F.log(p))
    decided = fused.withColumn("_post", _normal(logs))
    labels = F.array(*(F.lit(x) for x in names))
    best = lambda scores: F.get(labels, F.array_position(scores, F.array_max(scores)).cast("int") - 1)
    none = F.col("_logs").isNull()
    return decided.select(
        "_row.*", F.when(none, UNKNOWN).otherwise(best(F.col("_post"))).alias("language"),
        F.when(none, 1.0).otherwise(F.array_max("_post")).alias("probability"),
        F.when(none, UNKNOWN).otherwise(best(F.col("_logs"))).alias("text_language"))


PAGE_PARTS = ("text", "declared", "host", "domain", "suffix")


def page_parts(pages: DataFrame, url: str = "url", markup: str = "html") -> DataFrame:
    """`pages` with the visible `text`, the `declared` language, and `host`, `domain`, `suffix`
    of the address. Columns of `pages` that have these names are left out."""
    return _page_rows(pages, url, markup, [c for c in pages.columns if c not in PAGE_PARTS], [
        T.StructField("text", T.StringType()), T.StructField("declared", T.StringType())], lambda markup: visible(markup))


def _page_rows(pages: DataFrame, url: str, markup: str, kept: Sequence[str], added: Sequence[T.StructField],
               function) -> DataFrame:
    """The kept columns, what `function` makes of the markup, and the parts of the address."""
    rows = pages.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)),
                        *_address_parts(F.col(f"`{url}`")), F.col(f"`{markup}`").cast("string").alias("_markup"))
    schema = T.StructType([*rows.drop("_markup").schema.fields, *added])
    kinds = [to_arrow_type(field.dataType) for field in added]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.byte_sized(batches, "_markup"):
            found = zip(*map(function, batch.column("_markup").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(list(values), kind) for values, kind in zip(found, kinds))],
                names=schema.names)

    found = common.map_batches(rows, of_batches, schema)
    return found.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), *schema.names[len(kept):])


def _address_parts(address: Column) -> list[Column]:
    host = F.lower(F.regexp_extract(address, r"^[^:/?#]*://([^/?#]*)", 1))
    host = F.regexp_replace(host, r"^[^@]*@|:\d*$|\.$", "")
    labels = F.split(host, r"\.")
    domain = F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))
    return [F.coalesce(host, F.lit("")).alias("host"),
            F.coalesce(F.element_at(labels, -1), F.lit("")).alias("suffix"),
            F.coalesce(domain, F.lit("")).alias("domain")]


def _declared_in(tag: str) -> str | None:
    """The language code in the `lang` attribute of a tag."""
    for name, value in _ATTRIBUTE.findall(tag):
        if name.lower() == "lang":
            code = _CODE.match(value.strip("\"'"))
            return code[0].lower() if code else None
    return None


def visible(markup: str | None) -> tuple[str, str | None]:
    """Text outside tags, scripts, styles and comments, and the language that the first html tag
    declares. One pass: once an end is not found, no construct that needs it is looked for again.
    What is never closed counts as text."""
    if not markup:
        return "", None
    out, at, declared, seen, open_ended = [], 0, None, False, set()
    while (start := markup.find("<", at)) >= 0:
        out.append(markup[at:start])
        end = -1
        hidden = _HIDING.match(markup, start)
        if hidden and hidden[0].lower() not in open_ended:
            closed = _ENDS[hidden[0].lower()].search(markup, hidden.end())
            if closed:
                end = closed.end()
            else:
                open_ended.add(hidden[0].lower())
        if end < 0:
            end = markup.find(">", start) + 1
            if not end:
                out.append(markup[start:])
                return html.unescape("".join(out)), declared
            if not seen and _HTML.match(markup, start):
                seen, declared = True, _declared_in(markup[start + 5:end - 1])
        out.append(" ")
        at = end
    return html.unescape("".join([*out, markup[at:]])), declared


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """One row per page: its columns except the markup, the parts of its address, and its
    language. As `page_parts` and `identify`, without keeping the text."""
    kept = [c for c in pages.columns if c not in ("html", "declared", "host", "domain", "suffix", *ADDED)]
    added = [T.StructField("declared", T.StringType()), T.StructField("_logs", T.ArrayType(T.DoubleType()))]

    def evidence(markup: str | None) -> tuple:
        text, declared = visible(markup)
        return declared, model.evidence(text)

    levels = ["suffix", "domain", "host"]
    rows = lambda columns: _page_rows(pages, "url", "html", columns, added, evidence)
    carried = {c: c for c in (*kept, "declared", *levels)}
    return _decided(_keyed(rows([]), "declared", levels), _keyed(rows(kept), "declared", levels, carried),
                    model, len(levels))


def accepted(docs: DataFrame, text: str = "text", declared: str = "lang",
             source: str = "source") -> DataFrame:
    """The rows of `docs` whose language is known, all columns, with the label column as the
    declaration and the source in the place of the host. Columns may have any names."""
    model = fit(docs, text, declared)
    aside = common.free_name(docs, "_aside")
    rows = docs.select(*(F.col(f"`{c}`") for c in docs.columns), F.struct(
        *(F.col(f"`{c}`") for c in docs.columns if c in ADDED), F.lit(0).alias("_")).alias(aside))
    found = identify(rows, model, text, declared, [source]).where(F.col("language") != UNKNOWN)
    return found.select(*(F.col(aside).getField(c).alias(c) if c in ADDED else F.col(f"`{c}`") for c in docs.columns))
