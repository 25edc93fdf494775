"""Reads that set bad rows aside instead of stopping.

The input is parsed once into a written table whose rows are good or have a reason; both sides
are read from there. Nothing is dropped: good rows and bad rows add up to what was parsed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyrate import schemas
from tallyrate.sources.by_header import read_by_name
from tallyrate.storage import written_table

# Generated columns; input columns of these names are refused.
_RAW, _FILE, _REASON = "_raw_row", "_raw_file", "_raw_reason"


@dataclass(frozen=True)
class Split:
    """`good` rows, and `bad` ones as file, reason, row (the text as it was read)."""
    good: DataFrame
    bad: DataFrame

    def counts(self) -> DataFrame:
        """file, reason, n of the bad rows."""
        return self.bad.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n"))


def _split(parsed: DataFrame, name: str) -> Split:
    stored = written_table(parsed, name)
    return Split(stored.where(F.col(_REASON).isNull()).drop(_RAW, _FILE, _REASON),
                 stored.where(F.col(_REASON).isNotNull()).select(
                     F.col(_FILE).alias("file"), F.col(_REASON).alias("reason"), F.col(_RAW).alias("row")))


def _wrong(name: str, text: Column, kind) -> Column:
    """What to say of a cell whose text is not of its type; null of any other."""
    return F.when(text.isNotNull() & text.try_cast(kind).isNull(), F.concat(F.lit(f"{name} holds "), text))


def _csv_reason(schema: StructType) -> Column:
    """Why a row's text could not be read by `schema`: its cells are read again, as text."""
    cells = F.from_csv(F.col(_RAW), ", ".join(f"c{at} STRING" for at in range(len(schema) + 1)))
    found = [_wrong(field.name, cells[f"c{at}"], field.dataType) for at, field in enumerate(schema)]
    short = cells[f"c{len(schema) - 1}"].isNull() | cells[f"c{len(schema)}"].isNotNull()
    return F.coalesce(*found, F.when(short, F.lit(f"does not have {len(schema)} cells")), F.lit("cannot be read"))


def _scan(spark: SparkSession):
    def read(files: list[str], schema: StructType) -> DataFrame:
        if {_RAW, _FILE, _REASON} & set(schema.names):
            raise ValueError(f"columns named {_RAW}, {_FILE} or {_REASON} cannot be read")
        rows = spark.read.schema(StructType([*schema.fields, StructField(_RAW, StringType())])).csv(
            files, header=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_RAW)
        return rows.withColumns({
            _FILE: F.col("_metadata.file_path"),
            _REASON: F.when(F.col(_RAW).isNotNull(), _csv_reason(schema))})
    return read


def split_attempts(spark: SparkSession, path: str, schema: StructType = schemas.ATTEMPTS) -> Split:
    """Headed CSV files, each read by its own header. A row is bad that has more or fewer cells
    than its header, or a cell that is not of its column's type."""
    rows = read_by_name(spark, path, schema, _scan(spark))
    for name in {_RAW, _FILE, _REASON} - set(rows.columns):
        rows = rows.withColumn(name, F.lit(None).cast("string"))
    return _split(rows, "attempts-with-bad-rows")


def split_result_set(spark: SparkSession, path: str, fields: StructType = schemas.EVENTS, result: int = 0,
                     whole_files: bool = True) -> Split:
    """Rows of one result set of every JSON document, as `files.read_result_set` reads them. A
    document is one bad row when it is malformed or lacks the result set, and a
    row of it is bad that holds a cell which is not of its field's type."""
    schema = StructType([*schemas.RESULT_SET_DOCUMENT.fields, StructField(_RAW, StringType())])
    documents = spark.read.schema(schema).json(
        path, multiLine=whole_files, mode="PERMISSIVE", columnNameOfCorruptRecord=_RAW).withColumn(
        _FILE, F.col("_metadata.file_path"))
    found = F.get("resultSets", F.lit(result))
    whole = F.when(F.col(_RAW).isNotNull(), F.lit("is not a JSON document of result sets")).when(
        found["headers"].isNull() | found["rowSet"].isNull(), F.lit(f"has no result set {result}"))
    marked = documents.select(
        _FILE, whole.alias("_whole"), F.when(whole.isNotNull(), F.coalesce(_RAW, F.to_json(F.struct("resultSets")))).alias("_text"),
        found["headers"].alias("headers"), found["rowSet"].alias("rows"))
    rows = marked.select(_FILE, "_whole", "_text", "headers", F.posexplode_outer("rows").alias("position", "cells")).where(
        "_whole is not null or position is not null")
    texts = {field.name: F.get("cells", F.array_position("headers", F.lit(field.name)).cast("int") - 1) for field in fields}
    wrong = [_wrong(field.name, texts[field.name], field.dataType) for field in fields]
    reason = F.coalesce("_whole", *wrong)
    parsed = rows.select(
        "position", *(texts[field.name].try_cast(field.dataType).alias(field.name) for field in fields), _FILE,
        reason.alias(_REASON), F.when(reason.isNotNull(), F.coalesce("_text", F.to_json("cells"))).alias(_RAW))
    return _split(parsed, "events-with-bad-rows")
