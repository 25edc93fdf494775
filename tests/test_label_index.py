from __future__ import annotations

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tallyrate.operators.label_index import LabelIndexer, LabelIndexerModel


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [("b", 1, 7), ("b", 2, 7), ("a", 2, 7), ("c", 2, 7), (None, 3, 7)], "l string, m int, label int")


def numbers(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_most_frequent_first_and_ties_by_label(rows):
    model = LabelIndexer(inputCols=["l", "m"], outputCols=["li", "mi"]).fit(rows)
    assert model.sizes == [3, 3]
    found = model.transform(rows.where("l is not null"))
    assert found.columns == ["l", "m", "label", "li", "mi"]
    assert numbers(found, "l", "m", "li", "mi") == [("a", 2, 1.0, 0.0), ("b", 1, 0.0, 1.0), ("b", 2, 0.0, 0.0), ("c", 2, 2.0, 0.0)]
    assert numbers(model.labels("m"), "label", "number") == [(1, 1.0), (2, 0.0), (3, 2.0)]


def test_numbers_are_those_of_the_small_stage(rows):
    known = rows.where("l is not null")
    own = LabelIndexer(inputCols=["l"], outputCols=["n"]).fit(known).transform(known)
    small = StringIndexer(inputCol="l", outputCol="n", stringOrderType="frequencyDesc").fit(known).transform(known)
    assert numbers(own, "l", "n") == numbers(small, "l", "n")


def test_null_and_unseen_labels(rows, spark):
    seen = rows.where("l <> 'c'")
    for invalid, want in (("keep", [("a", 1.0), ("b", 0.0), ("b", 0.0), ("c", 2.0), ("null", 2.0)]),
                          ("skip", [("a", 1.0), ("b", 0.0), ("b", 0.0)])):
        model = LabelIndexer(inputCols=["l"], outputCols=["n"], handleInvalid=invalid).fit(seen)
        found = model.transform(rows).withColumn("l", F.coalesce("l", F.lit("null")))
        assert numbers(found, "l", "n") == want
    model = LabelIndexer(inputCols=["l"], outputCols=["n"]).fit(seen)
    for bad in ("l = 'c'", "l is null"):
        with pytest.raises(Exception, match="l holds a label that was not fitted: (c|null)"):
            model.transform(rows.where(bad)).collect()
    none = LabelIndexer(inputCols=["l"], outputCols=["n"], handleInvalid="keep").fit(rows.limit(0))
    assert numbers(none.transform(rows), "n") == [(0.0,)] * 5


def test_clashing_and_odd_column_names(spark):
    rows = spark.createDataFrame([("x", 1, 2, 3), ("x", 4, 5, 6), ("y", 7, 8, 9)], "`a.b` string, number int, _row int, _label int")
    model = LabelIndexer(inputCols=["a.b", "number"], outputCols=["n", "m"]).fit(rows)
    found = model.transform(rows)
    assert found.columns == ["a.b", "number", "_row", "_label", "n", "m"]
    assert sorted(tuple(r) for r in found.collect()) == [("x", 1, 2, 3, 0.0, 0.0), ("x", 4, 5, 6, 0.0, 1.0), ("y", 7, 8, 9, 1.0, 2.0)]


def test_settings_are_checked(rows):
    for bad in (dict(inputCols=["l"], outputCols=["l"]), dict(inputCols=["l", "m"], outputCols=["n"]),
                dict(inputCols=["l"], outputCols=["n"], handleInvalid="maybe")):
        with pytest.raises(ValueError):
            LabelIndexer(**bad).fit(rows)


def test_estimator_and_model_are_saved(rows, spark, tmp_path):
    indexer = LabelIndexer(inputCols=["l", "m"], outputCols=["li", "mi"], handleInvalid="skip")
    indexer.write().overwrite().save(str(tmp_path / "estimator"))
    again = LabelIndexer.load(str(tmp_path / "estimator"))
    assert (again.uid, again.getHandleInvalid(), again.getInputCols()) == (indexer.uid, "skip", ["l", "m"])
    model = again.fit(rows)
    for _ in range(2):
        model.write().overwrite().save(str(tmp_path / "model"))
    loaded = LabelIndexerModel.load(str(tmp_path / "model"))
    assert loaded.uid == model.uid and loaded.sizes == model.sizes
    assert numbers(loaded.transform(rows), "l", "li", "mi") == numbers(model.transform(rows), "l", "li", "mi")
    kept = loaded.copy({loaded.getParam("handleInvalid"): "keep"})
    assert kept.transform(rows).count() == 5 and loaded.transform(rows).count() == 4


def test_a_saved_pipeline_of_a_million_labels(spark, tmp_path):
    count = 1_000_000
    rows = spark.range(count + count // 4).select(
        "id", F.when(F.col("id") % 1000 == 999, None).otherwise(F.concat(F.lit("label "), F.col("id") % count)).alias("label"))
    fitted = rows.where(f"id % 10 <> 3 and id <> {count - 5}")
    pipeline = Pipeline(stages=[LabelIndexer(inputCols=["label"], outputCols=["n"], handleInvalid="keep"),
                                VectorAssembler(inputCols=["n"], outputCol="v")])
    pipeline.fit(fitted).write().save(str(tmp_path / "m"))
    model = PipelineModel.load(str(tmp_path / "m"))
    size = fitted.where("label is not null").select("label").distinct().count()
    assert model.stages[0].sizes == [size] and size > 890_000
    found = model.transform(rows)
    assert found.where("n = " + str(size)).count() == rows.where(f"label is null or id % 10 = 3 or id = {count - 5}").count()
    assert found.count() == count + count // 4 and found.select("n").distinct().count() == size + 1
    assert found.where("label = 'label 0'").first().n < size
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
