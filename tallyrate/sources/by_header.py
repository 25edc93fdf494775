"""Headed CSV files that name or order their columns differently, merged by name.

One pass over the lines gives each file's header. Files of equal header are one scan, with the
schema that their header asks for; the scans are united by name, and a column a file lacks is null.
The plan grows with the number of different headers, not of files.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyrate import schemas

Scan = Callable[[list[str], StructType], DataFrame]


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """header, files: the first line that is not blank, and the files that start with it. Files
    without such a line are left out."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    placed = lines.where("start = 0 and trim(value) <> ''").withColumn("place", F.monotonically_increasing_id())
    first = placed.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    return first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))


def names_of(header: str) -> list[str]:
    """Column names of a header line; an unnamed first one is `index` where none is, any other
    unnamed one `_c` and its place."""
    names = next(csv.reader([header.removeprefix("﻿")]))
    named = ["index" if at == 0 and not name and "index" not in names else name or f"_c{at}"
             for at, name in enumerate(names)]
    if len(set(named)) < len(named):
        raise ValueError(f"a header names a column twice: {header}")
    return named


def _literal(file: str) -> str:
    """A listed file's own name as a path to read, in which no character is a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def failing(spark: SparkSession) -> Scan:
    """Scans whose cells must be of their columns' types."""
    return lambda files, schema: spark.read.schema(schema).csv(
        files, header=True, enforceSchema=True, mode="FAILFAST")


def read_by_name(spark: SparkSession, path: str, schema: StructType = schemas.ATTEMPTS, scan: Scan | None = None) -> DataFrame:
    """All rows of all files. Columns of `schema` that any file has come first, in its order and
    with its types, then other columns by name, as text. Without files there are no rows and
    all columns of `schema`."""
    known = {field.name: field for field in schema}
    frames, present = [], set()
    for row in catalogue(spark, path).orderBy("header").collect():
        names = names_of(row.header)
        typed = StructType([known.get(name, StructField(name, StringType())) for name in names])
        frames.append((scan or failing(spark))([_literal(file) for file in row.files], typed))
        present.update(names)
    if not frames:
        return spark.createDataFrame([], schema)
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    ordered = [name for name in known if name in present] + sorted(present - set(known))
    kept = [name for name in merged.columns if name not in present]
    return merged.select(*(F.col(f"`{name}`") for name in ordered + kept))
