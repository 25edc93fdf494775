"""Fitted tree ensembles as a table of nodes and as SQL over the columns a pipeline reads.

A saved ensemble is a table of nodes already. `nodes` brings it into one shape; `prediction_sql`
turns it, with the pipeline's encoders in front, into one expression without vectors. The
expression is plain SQL, so that Spark runs it inside generated code (`with_prediction`) and any
other engine can score the same rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import MaxAbsScalerModel, OneHotEncoderModel, VectorAssembler, VectorIndexerModel
from pyspark.ml.regression import (DecisionTreeRegressionModel, GBTRegressionModel,
                                   RandomForestRegressionModel)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrate.storage import fresh_path


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of a regression tree, forest or boosted ensemble saved at `path`.

    tree, node, feature, threshold (rows up to it go left) or categories (rows in it go left), left,
    right, value (the mean label of the node's training rows), n (their number). Leaves
    have neither feature nor children.
    """
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" not in saved.columns:
        saved = saved.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    inner = F.col("nodeData.leftChild") >= 0
    continuous = F.col("nodeData.split.numCategories") < 0
    split = F.col("nodeData.split.leftCategoriesOrThreshold")
    return saved.select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.when(inner, F.col("nodeData.split.featureIndex")).alias("feature"),
        F.when(inner & continuous, F.get(split, F.lit(0))).alias("threshold"),
        F.when(inner & ~continuous, split).alias("categories"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"),
        F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.col("nodeData.prediction").alias("value"), F.col("nodeData.rawCount").alias("n"))


def nodes(regressor) -> DataFrame:
    """The same of a fitted regression model."""
    spark = SparkSession.active()
    path = fresh_path(spark, "tree-nodes")
    regressor.write().save(path)
    return read_nodes(spark, path)


def weights(regressor) -> list[float]:
    """What each tree's value counts for in the prediction."""
    if isinstance(regressor, GBTRegressionModel):
        return list(regressor.treeWeights)
    if isinstance(regressor, RandomForestRegressionModel):
        return [1 / regressor.getNumTrees] * regressor.getNumTrees
    if isinstance(regressor, DecisionTreeRegressionModel):
        return [1.0]
    raise TypeError(f"{type(regressor).__name__} is not a regression tree or ensemble of such")


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _quoted(column: str) -> str:
    return '"' + column.replace('"', '""') + '"'


def feature_sql(stages: Sequence, column: str) -> list[str]:
    """SQL of each entry of a pipeline's vector column, over the columns that the pipeline reads.

    Knows one-hot encoders, assemblers, largest-value scalers and vector indexers. A level an
    encoder does not know has no slot set, a value an indexer does not know is null or, if it
    keeps such, the category behind the known ones.
    """
    known: dict[str, list[str]] = {}

    def entries(name: str) -> list[str]:
        return known.get(name) or [f"CAST({_quoted(name)} AS DOUBLE)"]

    for stage in stages:
        if isinstance(stage, OneHotEncoderModel):
            if stage.getHandleInvalid() != "error":
                raise ValueError("only encoders that refuse unknown levels can be written as SQL")
            for name, output, size in zip(stage.getInputCols(), stage.getOutputCols(), stage.categorySizes):
                known[output] = [f"CASE WHEN {_quoted(name)} = {level} THEN 1 ELSE 0 END"
                                 for level in range(size - stage.getDropLast())]
        elif isinstance(stage, VectorAssembler):
            known[stage.getOutputCol()] = [sql for name in stage.getInputCols() for sql in entries(name)]
        elif isinstance(stage, MaxAbsScalerModel):
            scales = [1 / value if value else 1.0 for value in stage.maxAbs.toArray().tolist()]
            known[stage.getOutputCol()] = [f"({sql}) * {_number(scale)}"
                                           for sql, scale in zip(entries(stage.getInputCol()), scales)]
        elif isinstance(stage, VectorIndexerModel):
            known[stage.getOutputCol()] = [
                _category(sql, stage.categoryMaps.get(at), stage.getHandleInvalid())
                for at, sql in enumerate(entries(stage.getInputCol()))]
    if column not in known:
        raise ValueError(f"no stage makes the vector {column}")
    return known[column]


def _category(sql: str, numbers: dict[float, int] | None, invalid: str) -> str:
    if numbers is None:
        return sql
    cases = " ".join(f"WHEN {_number(value)} THEN {at}" for value, at in sorted(numbers.items()))
    return f"CASE {sql} {cases} ELSE {len(numbers) if invalid == 'keep' else 'NULL'} END"


def tree_sql(rows: Sequence, features: Sequence[str], leaf: str = "value") -> str:
    """One tree as nested cases; `leaf` names the column of its nodes that it ends in."""
    by_number = {row.node: row for row in rows}

    def below(number: int) -> str:
        row = by_number[number]
        if row.feature is None:
            return _number(row[leaf]) if leaf == "value" else str(row[leaf])
        if row.categories is None:
            left = f"{features[row.feature]} <= {_number(row.threshold)}"
        else:
            left = f"{features[row.feature]} IN ({', '.join(map(_number, row.categories))})"
        return f"CASE WHEN {left} THEN {below(row.left)} ELSE {below(row.right)} END"

    return below(0)


def trees_of(table: DataFrame) -> list[list]:
    """The nodes of each tree, in order. Their number is a setting of the fit (trees times two
    to the depth), not of the data."""
    found = defaultdict(list)
    for row in table.collect():
        found[row.tree].append(row)
    return [found[tree] for tree in sorted(found)]


def vector_column(model: PipelineModel) -> str:
    return model.stages[-1].getFeaturesCol()


def prediction_sql(model: PipelineModel) -> str:
    """The prediction of a fitted pipeline as SQL over its input columns. It is null where an
    input of it is null."""
    regressor = model.stages[-1]
    features = feature_sql(model.stages[:-1], vector_column(model))
    inputs = sorted({name for stage in model.stages[:-1] for name in _read_by(stage)}
                    - {name for stage in model.stages[:-1] for name in _made_by(stage)})
    terms = [f"{_number(weight)} * ({tree_sql(rows, features)})"
             for weight, rows in zip(weights(regressor), trees_of(nodes(regressor)), strict=True)]
    known = " AND ".join(f"{_quoted(name)} IS NOT NULL" for name in inputs)
    return f"CASE WHEN {known} THEN {' + '.join(terms)} END"


def _read_by(stage) -> list[str]:
    return stage.getInputCols() if isinstance(stage, (OneHotEncoderModel, VectorAssembler)) else [stage.getInputCol()]


def _made_by(stage) -> list[str]:
    return stage.getOutputCols() if isinstance(stage, OneHotEncoderModel) else [stage.getOutputCol()]


def spark_sql(text: str) -> str:
    """The same text with names quoted as Spark quotes them."""
    return text.replace('"', "`")


def with_prediction(df: DataFrame, model: PipelineModel, name: str = "prediction") -> DataFrame:
    """`df` with the pipeline's prediction, as one expression; no vector is built."""
    return df.withColumn(name, F.expr(spark_sql(prediction_sql(model))))


def with_leaf(df: DataFrame, model: PipelineModel, tree: int, name: str = "leaf") -> DataFrame:
    """`df` with the number of the leaf that each row reaches in one tree."""
    rows = trees_of(nodes(model.stages[-1]))[tree]
    features = feature_sql(model.stages[:-1], vector_column(model))
    return df.withColumn(name, F.expr(spark_sql(tree_sql(rows, features, "node"))))
