"""A label indexer for any number of labels, as a stage of saved pipelines.

The fitted state is a table of (label, number) per column, most frequent label first and equal
counts by label. It is written when fitted, copied when the model is saved, and joined when rows
are transformed: labels never pass through the driver, and a hot label is a join key that
adaptive execution can split.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrate.operators.indexing import frequency_index
from tallyrate.storage import written_table

INVALID = ("error", "skip", "keep")


class _Settings(HasInputCols, HasOutputCols):
    handleInvalid = Param(Params._dummy(), "handleInvalid", "a label that is null or was not fitted: "
                          "error stops, skip drops the row, keep gives the number of labels",
                          TypeConverters.toString)

    def getHandleInvalid(self) -> str:
        return self.getOrDefault(self.handleInvalid)

    def _checked(self) -> list[tuple[str, str]]:
        if self.getHandleInvalid() not in INVALID:
            raise ValueError(f"handleInvalid is one of {', '.join(INVALID)}")
        columns = list(zip(self.getInputCols(), self.getOutputCols(), strict=True))
        outputs = [output for _, output in columns]
        if len({*outputs, *self.getInputCols()}) < 2 * len(outputs):
            raise ValueError("input and output columns must all differ")
        return columns


class LabelIndexer(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers the labels of each input column from 0; nulls are not counted."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, handleInvalid="error"):
        super().__init__()
        self._setDefault(handleInvalid="error")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LabelIndexerModel:
        tables = [written_table(frequency_index(dataset.select(F.col(f"`{name}`").alias("label")), "label")
                                .select("label", F.col("index").cast("double").alias("number")), "labels")
                  for name, _ in self._checked()]
        return self._copyValues(LabelIndexerModel()._with_tables(tables))


class LabelIndexerModel(Model, _Settings, MLReadable, MLWritable):
    """Adds each label's number, a double. Rows keep their number and their other columns."""

    def __init__(self):
        super().__init__()
        self._setDefault(handleInvalid="error")
        self.tables: list[DataFrame] = []
        self.sizes: list[int] = []

    def _with_tables(self, tables: list[DataFrame], sizes: list[int] | None = None) -> LabelIndexerModel:
        self.tables = tables
        self.sizes = sizes or [table.count() for table in tables]
        return self

    def copy(self, extra=None) -> LabelIndexerModel:
        return super().copy(extra)._with_tables(self.tables, self.sizes)

    def labels(self, column: str) -> DataFrame:
        """label, number of one input column."""
        return self.tables[self.getInputCols().index(column)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        invalid = self.getHandleInvalid()
        for (name, output), table, size in zip(self._checked(), self.tables, self.sizes):
            row = F.struct(*(F.col(f"`{column}`") for column in dataset.columns))
            # Generated names only: the rows' own columns stay inside one struct during the join.
            rows = dataset.select(row.alias("_row"), F.col(f"`{name}`").alias("_label"))
            known = table.select(F.col("label").alias("_known"), F.col("number").alias("_number"))
            how = "inner" if invalid == "skip" else "left"
            found = rows.join(known, F.col("_label") == F.col("_known"), how)
            number = F.col("_number")
            if invalid == "keep":
                number = F.coalesce(number, F.lit(float(size)))
            elif invalid == "error":
                text = F.concat(F.lit(f"{name} holds a label that was not fitted: "),
                                F.coalesce(F.col("_label").cast("string"), F.lit("null")))
                number = F.coalesce(number, F.raise_error(text).cast("double"))
            dataset = found.select("_row.*", number.alias(output))
        return dataset

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: LabelIndexerModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, {"sizes": self.instance.sizes})
        for at, table in enumerate(self.instance.tables):
            table.write.parquet(f"{path}/labels/{at}")


class _Reader(MLReader):
    def __init__(self, kind: type[LabelIndexerModel]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> LabelIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        sizes = metadata["sizes"]
        spark = SparkSession.active()
        return model._with_tables([spark.read.parquet(f"{path}/labels/{at}") for at in range(len(sizes))], sizes)
