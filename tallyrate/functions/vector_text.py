"""Vectors as text, the way they stand in CSV files: dense `[1.0,2.0]`, sparse `(4,[0,3],[1.0,2.0])`."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

_LIST = r"\[([^\[\]()]*)\]"
_DENSE = f"^{_LIST}$"
_SPARSE = rf"^\(([0-9]{{1,9}}),{_LIST},{_LIST}\)$"


def _refuse(text: Column, kind: str) -> Column:
    return F.raise_error(F.concat(F.lit("not a vector: "), text)).cast(kind)


def _numbers(listed: Column, kind: str, text: Column) -> Column:
    """The numbers of a comma-separated list; an empty list has none."""
    cells = F.when(listed == "", F.array().cast("array<string>")).otherwise(F.split(listed, ",", -1))
    return F.transform(cells, lambda cell: F.coalesce(cell.try_cast(kind), _refuse(text, kind)))


def _last(places: Column) -> Column:
    return F.coalesce(F.get(places, F.size(places) - 1), F.lit(-1))


def _spread(size: Column, places: Column, values: Column) -> Column:
    """All entries of a sparse vector, zeros between the given ones; work grows with its size."""
    gap = F.transform(values, lambda value, i: F.concat(
        F.array_repeat(F.lit(0.0), F.get(places, i) - F.coalesce(F.get(places, i - 1), F.lit(-1)) - 1), F.array(value)))
    rest = F.array_repeat(F.lit(0.0), size - 1 - _last(places))
    return F.concat(F.flatten(gap), rest)


def entries(text: Column) -> Column:
    """The entries (array of double) that a vector's text gives. White space does not count and
    null stays null. Anything else than the two forms stops: a cell that is no number, places
    that do not ascend or lie outside, other numbers of places than of values."""
    plain = F.regexp_replace(text, r"\s", "")
    places = _numbers(F.regexp_extract(plain, _SPARSE, 2), "int", text)
    values = _numbers(F.regexp_extract(plain, _SPARSE, 3), "double", text)
    size = F.regexp_extract(plain, _SPARSE, 1).try_cast("int")
    ascending = F.forall(F.transform(places, lambda at, i: at > F.coalesce(F.get(places, i - 1), F.lit(-1))), lambda up: up)
    fits = (F.size(places) == F.size(values)) & ascending & (_last(places) < size)
    return F.when(text.isNull(), F.lit(None).cast("array<double>")).when(
        plain.rlike(_DENSE), _numbers(F.regexp_extract(plain, _DENSE, 1), "double", text)).when(
        plain.rlike(_SPARSE) & fits, _spread(size, places, values)).otherwise(_refuse(text, "array<double>"))


def to_vector(text: Column) -> Column:
    return F.when(text.isNotNull(), array_to_vector(F.coalesce(entries(text), F.array().cast("array<double>"))))


def _array(vector: Column) -> Column:
    return F.when(vector.isNotNull(), vector_to_array(vector))


def dense_text(vector: Column) -> Column:
    """The dense form; null stays null."""
    numbers = F.transform(_array(vector), lambda value: value.cast("string"))
    return F.concat(F.lit("["), F.array_join(numbers, ","), F.lit("]"))


def sparse_text(vector: Column) -> Column:
    """The sparse form, of the entries other than zero."""
    array = _array(vector)
    kept = F.filter(F.transform(array, lambda value, i: F.struct(i.alias("i"), value.alias("value"))), lambda x: x["value"] != 0)
    places = F.array_join(F.transform(kept, lambda x: x["i"].cast("string")), ",")
    values = F.array_join(F.transform(kept, lambda x: x["value"].cast("string")), ",")
    return F.concat(F.lit("("), F.size(array).cast("string"), F.lit(",["), places, F.lit("],["), values, F.lit("])"))
