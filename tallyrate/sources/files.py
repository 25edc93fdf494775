"""CSV, JSON result sets, text lines, rate tables and requests."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyrate import schemas
from tallyrate.functions import vector_text


def read_csv(spark: SparkSession, path: str, schema: StructType | None = schemas.ATTEMPTS) -> DataFrame:
    """Headed CSV whose header must name the schema's columns; an empty cell is
    null, and a cell that is not of its column's type stops the read. Without a schema the
    types are inferred, at the price of a pass, and an unnamed index column is called `_c0`."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False, mode="FAILFAST")


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """Attempts from a headed CSV that may lack some of the known columns or have
    others, which are read as text. An unnamed first column becomes `index`.

    The header of every file is held against that of the first: files that name or order their
    columns differently stop the read, and so does a cell that is not of its column's type.
    """
    known = {field.name: field for field in schemas.ATTEMPTS}
    first = spark.read.csv(path, header=False).first()
    header = [name or "" for name in first] if first else schemas.ATTEMPTS.names
    named = ["index" if at == 0 and not name and "index" not in header else name or f"_c{at}"
             for at, name in enumerate(header)]
    types = [known[name].dataType if name in known else StringType() for name in named]
    fields = [StructField(name, kind) for name, kind in zip(header, types)]
    read = spark.read.schema(StructType(fields)).csv(
        path, header=True, enforceSchema=False, mode="FAILFAST")
    return read.toDF(*named)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def read_result_set(spark: SparkSession, path: str, fields: StructType = schemas.EVENTS,
                    result: int = 0, whole_files: bool = True) -> DataFrame:
    """Rows of one result set of every JSON document under `path`.

    A document holds parallel `headers` and `rowSet` arrays. Cells are picked by
    header, so documents may order their columns differently; a header absent
    from a document gives nulls. `position` is the row's place in its document.
    `whole_files` reads one document per file, otherwise one per line. A malformed document,
    and a cell that is not of its field's type, stop the read.
    """
    documents = spark.read.schema(schemas.RESULT_SET_DOCUMENT).json(
        path, multiLine=whole_files, mode="FAILFAST")
    rows = documents.select(F.get("resultSets", F.lit(result)).alias("r")).select(
        "r.headers", F.posexplode("r.rowSet").alias("position", "cells"))
    return rows.select("position", *(_typed_cell(field) for field in fields))


def _typed_cell(field: StructField) -> Column:
    cell = F.get("cells", F.array_position("headers", F.lit(field.name)).cast("int") - 1)
    value = cell.try_cast(field.dataType)
    wrong = F.raise_error(F.concat(F.lit(f"{field.name} holds "), cell)).cast(field.dataType)
    return F.when(cell.isNotNull() & value.isNull(), wrong).otherwise(value).alias(field.name)


def with_constant(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_text(spark: SparkSession, line: str, path: str) -> None:
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_rates(rates: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet, which keeps vectors as they are."""
    rates.write.mode(mode).parquet(path)


def vector_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, VectorUDT)]


def write_rates_csv(rates: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV, vectors as dense text."""
    texts = {name: vector_text.dense_text(F.col(f"`{name}`")) for name in vector_columns(rates)}
    write_csv(rates.withColumns(texts), path, mode)


def read_rates_csv(spark: SparkSession, path: str, vectors: Sequence[str] = ("features",)) -> DataFrame:
    """A rate table from headed CSV, types inferred in a pass of their own. Those of `vectors`
    that the table has are vectors, written as dense or sparse text; malformed text stops the read."""
    rows = spark.read.csv(path, header=True, inferSchema=True)
    present = [name for name in vectors if name in rows.columns]
    return rows.withColumns({name: vector_text.to_vector(F.col(f"`{name}`").cast("string")) for name in present})


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def requests_from_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """A few hand-written scoring requests; larger request tables are read."""
    return spark.createDataFrame(list(rows), schemas.REQUESTS)
