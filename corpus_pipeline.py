"""Stages that turn `documents` into encoded training text.

Each stage takes (spark, docs, sf_dir) and returns a frame; `run` writes it as Parquet and reads
it back as the next stage's documents. The last stage returns the encodings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrate.llm import bpe, exact_dedup, language_id, mixing, simhash, tokens
from tallyrate.storage import scope

VOCABULARY = "word_bpe_49k.json"


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without any letter, or more like noise than
    like any language, go. With no rows in, none come out."""
    return language_id.accepted(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the least id."""
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, 3 bits): the least id."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to 3 times, each copy a row."""
    return mixing.mixed_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix: doc_id, n_tokens, and digests of ids and decoded text."""
    found = bpe.encode(docs, tokens.public_path(VOCABULARY))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identified),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("mix_sources", mixed),
    ("bpe_encode_decode", encoded),
]

# The trigram model, the fingerprints and the encodings are not SQL; tests hold the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's own tables go when its output is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scope(spark) as tables:
            docs = tables.keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
