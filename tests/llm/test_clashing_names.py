"""Tables whose columns have the names that operators use, and names that need quoting."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyrate.llm import (exact_dedup, language_id, lexical_search, line_dedup, mixing, quality_rules, simhash,
                           suffix_dedup, token_alignment, token_counts, tokens)

NAMES = ("_id", "_row", "_gone", "_clashing", "a.b", "_key", "_kept", "_doc", "_own_id", "_aside", "_text", "_maybe", "id", "key",
         "language", "probability", "hash", "size", "place", "tie", "copies", "_source", "row", "term", "words", "failures", "kept")
TEXTS = ["the quick brown fox jumps over the dog and runs away from the old house"] * 3 + [
    "the quick brown fox jumps over the dog and runs away from the new house", "der alte mann und das meer sind nicht von hier",
    None, "", "one line\none line\nanother line that is long enough to be compared", "the end of the story is not known to any of us"]


@pytest.fixture(scope="module")
def docs(spark):
    """Ids that repeat and are null, with every clashing column."""
    rows = [(i if i not in (1, 2) else 0, t, ("en", "de", None)[i % 3], f"s{i % 2}", len(t or ""), *[7] * len(NAMES))
            for i, t in enumerate(TEXTS)] + [(None, "no id here at all", "en", "s0", 17, *[7] * len(NAMES))] * 2
    columns = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{n}` int" for n in NAMES)
    return spark.createDataFrame(rows, columns)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, docs, name, stage):
    out = stage(spark, docs, "")
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    rows = out.collect()
    assert rows and all(r["a.b"] == r["_row"] == 7 for r in rows)
    if name == "exact_dedup":
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [
            (False, 0), (False, 3), (False, 4), (False, 5), (False, 7), (False, 8), (True, 0)]


BYTE, PIECE = tokens.public_path("byte_bpe_50k.json"), tokens.public_path("piece_bpe_32k.model")
OPERATORS = {
    "last stage": lambda docs: corpus_pipeline.STAGES[-1][1](docs.sparkSession, docs, ""),
    "mix": mixing.mix, "counts": lambda docs: token_counts.count(docs, BYTE), "lines": line_dedup.near_duplicates,
    "simhash": simhash.near_duplicates, "digests": exact_dedup.duplicates,
    "repeats": lambda docs: suffix_dedup.remove_repeats(docs, length=20), "ledger": quality_rules.ledger,
    "alignment": lambda docs: token_alignment.align(docs, BYTE, PIECE)}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_read_only_the_named_columns(docs, name):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    listed = lambda df: sorted(map(str, df.collect()))
    assert listed(OPERATORS[name](docs)) == listed(OPERATORS[name](plain))


def test_lines_are_taken_out_of_any_table(docs):
    found = line_dedup.near_duplicates(docs)
    out = line_dedup.cleaned(docs, found)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("doc_id = 7").first().text.count("one line") == 1


def test_search_and_identification(spark, docs):
    items = spark.createDataFrame([(1, "quick story", 7, 7)], "item_id long, text string, row int, id int")
    assert lexical_search.rank(docs, items).count() == 5
    model = language_id.fit(docs)
    found = language_id.identify(docs, model, "text", "lang", ["source"])
    assert found.count() == docs.count() and found.select(F.col("`a.b`")).first()[0] == 7
