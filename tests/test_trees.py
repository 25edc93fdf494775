"""Node tables and the SQL compiled from them, against the models' own predictions."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from tallyrate import jobs
from tallyrate.operators import features, models, trees
from tallyrate.plans import scoring, training
from tests.test_jobs import keep_session_tables  # noqa: F401
from tests.test_models import planted  # noqa: F401


@pytest.fixture(scope="module")
def cells(planted):  # noqa: F811
    """Margins that vary, so that the indexer has categories and the trees split on them."""
    margin = (F.xxhash64("x_center_scaled", "period") % 3).cast("int")
    return planted.withColumns({
        "margin_cat": margin, "margin_scaled": margin / 2, "fg": F.col("fg") + F.when(margin == 1, 0.3).otherwise(0.0)}).cache()


def fitted(cells, regressor, learned: bool):
    train = training.train_cluster_model if learned else training.train_zone_model
    return train(cells, regressor)


@pytest.mark.parametrize("learned", [False, True])
@pytest.mark.parametrize("regressor", [models.forest, models.boosted])
def test_expression_predicts_as_the_model(cells, regressor, learned):
    model, predicted = fitted(cells, regressor(), learned)
    both = trees.with_prediction(predicted, model, "compiled")
    assert both.agg(F.max(F.abs(F.col("compiled") - F.col("prediction")))).first()[0] <= 1e-12
    assert both.select("compiled").distinct().count() > 20
    plan = trees.with_prediction(cells, model)._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Exchange" not in plan
    if learned:
        assert trees.nodes(models.regressor_of(model)).where("categories is not null").count() > 0


@pytest.mark.parametrize("learned", [False, True])
def test_other_engines_run_the_same_text(cells, learned):
    model, predicted = fitted(cells, models.boosted(), learned)
    names = ("x_center", "y_center", "margin_cat") if learned else ("x_center_scaled", "y_center_scaled", "margin_scaled")
    held = predicted.select(*names, "dist_bin", "period", "prediction").toPandas()  # noqa: F841
    worst = duckdb.sql(f"select max(abs(({trees.prediction_sql(model)}) - prediction)), count(*) from held").fetchall()[0]
    assert worst[0] <= 1e-12 and worst[1] == predicted.count()


def test_nodes_are_trees(cells):
    model, _ = fitted(cells, models.forest(), False)
    table = trees.nodes(models.regressor_of(model))
    inner = table.where("feature is not null")
    assert table.select("tree").distinct().count() == 20
    children = inner.select("tree", F.explode(F.array("left", "right")).alias("node"))
    assert children.count() == children.distinct().count() == table.where("node > 0").count()
    kids = inner.select("tree", "n", F.col("left").alias("node"), "right").join(
        table.select("tree", "node", F.col("n").alias("n_left")), ["tree", "node"]).select(
        "tree", "n", "n_left", F.col("right").alias("node")).join(
        table.select("tree", "node", F.col("n").alias("n_right")), ["tree", "node"])
    assert kids.where("n <> n_left + n_right").count() == 0 and kids.count() == inner.count()
    assert table.where("feature is null and (threshold is not null or left is not null)").count() == 0


def test_leaves_hold_the_mean_of_their_rows(cells):
    model, _ = fitted(cells, models.boosted(iterations=1), False)
    leaves = {r.node: (r.n, r.value) for r in trees.nodes(models.regressor_of(model)).where("feature is null").collect()}
    routed = trees.with_leaf(cells.where("is_train"), model, 0).groupBy("leaf").agg(F.count("*").alias("n"), F.avg("fg").alias("m"))
    assert {r.leaf: (r.n, pytest.approx(r.m)) for r in routed.collect()} == leaves


def test_a_null_input_has_no_prediction(cells, spark):
    model, _ = fitted(cells, models.forest(), False)
    rows = spark.createDataFrame([(0.5, 0.0, 0, 0.0, None), (None, 0.0, 0, 0.0, 1), (float("nan"), 0.0, 0, 0.0, 1)],
                                 "x_center_scaled double, y_center_scaled double, dist_bin int, margin_scaled double, period int")
    assert [r.prediction is None for r in trees.with_prediction(rows, model).collect()] == [True, True, False]


def test_scoring_through_the_expression_is_the_same(cells, spark):
    for learned in (False, True):
        model, _ = fitted(cells, models.forest(), learned)
        columns = ("x_center", "y_center") if learned else ("x_center_scaled", "y_center_scaled")
        requests = cells.select(*columns, (F.col("dist_bin") + 1).alias("dist_bin"),
                                F.nullif("margin_cat", F.lit(2)).alias("margin_cat"), "period")
        own = scoring.score(model, requests)
        other = scoring.score(model, requests, lambda df: trees.with_prediction(df, model))
        rounded = lambda df: sorted(map(str, df.withColumn("prediction", F.round("prediction", 9)).collect()))
        assert rounded(own) == rounded(other)


def test_one_tree_and_stages_that_cannot_be_written(cells, spark):
    assembled = [features.one_hot_encoder(spark), features.assembler()]
    tree = Pipeline(stages=[*assembled, DecisionTreeRegressor(labelCol="fg", featuresCol="features")]).fit(cells)
    both = trees.with_prediction(tree.transform(cells), tree, "compiled")
    assert both.where("abs(compiled - prediction) > 1e-12").count() == 0
    linear = Pipeline(stages=[*assembled, LinearRegression(labelCol="fg", featuresCol="features")]).fit(cells)
    with pytest.raises(TypeError):
        trees.prediction_sql(linear)
    keeping = Pipeline(stages=[OneHotEncoder(inputCol="period", outputCol="p", handleInvalid="keep"),
                               VectorAssembler(inputCols=["p"], outputCol="features"),
                               DecisionTreeRegressor(labelCol="fg")]).fit(cells)
    with pytest.raises(ValueError):
        trees.prediction_sql(keeping)


def test_jobs_export_and_score_by_expression(cells, spark, tmp_path):
    model, predicted = fitted(cells, models.forest(), False)
    models.save(model, str(tmp_path / "model"))
    jobs.main(["export-sql", "--model", str(tmp_path / "model"), "--out", str(tmp_path / "sql")])
    text = spark.read.text(str(tmp_path / "sql")).collect()
    assert len(text) == 1
    held = predicted.withColumn("compiled", F.expr(trees.spark_sql(text[0].value)))
    assert held.where("abs(compiled - prediction) > 1e-12").count() == 0
    requests = str(tmp_path / "requests")
    cells.select("x_center_scaled", "y_center_scaled", "dist_bin", "margin_cat", "period").write.csv(requests, header=True)
    found = []
    for more in ([], ["--as-sql"]):
        out = str(tmp_path / f"scored{len(more)}")
        jobs.main(["score", "--model", str(tmp_path / "model"), "--requests", requests, "--out", out, *more])
        found.append(sorted((r.x_center_scaled, r.dist_bin, r.margin_cat, r.period, round(float(r.prediction), 9))
                            for r in spark.read.csv(out, header=True).collect()))
    assert found[0] == found[1] and len(found[0]) == cells.count()
