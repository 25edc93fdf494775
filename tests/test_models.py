"""Encoders, pipelines, persistence and scoring, on rates with a planted signal."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyrate.operators import evaluate, features, models, zones
from tallyrate.plans import learned_zones, scoring, training
from tallyrate.sources import files
from tallyrate.storage import fixed_order_table
from tests.test_rates import attempts


@pytest.fixture(scope="module")
def planted(spark):
    """The rate falls with the distance bin and rises along the court."""
    grid = spark.range(7 * 5 * 12).select(
        (F.col("id") % 7).cast("int").alias("dist_bin"),
        (F.floor(F.col("id") / 7) % 5 + 1).cast("int").alias("period"),
        (F.floor(F.col("id") / 35) % 12 / 12).alias("x_center_scaled"))
    return grid.withColumns({
        "y_center_scaled": F.lit(0.0), "margin_cat": F.lit(0), "margin_scaled": F.lit(0.0),
        "fg": F.round(0.2 + 0.4 * F.col("x_center_scaled") - 0.02 * F.col("dist_bin"), 2),
        "x_center": F.col("x_center_scaled") * 47, "y_center": F.lit(25.0),
        "is_train": F.xxhash64("dist_bin", "period", "x_center_scaled") % 10 < 4}).cache()


def test_one_hot_keeps_every_level(spark):
    rows = spark.createDataFrame([(0, 1), (6, 5)], "dist_bin int, period int")
    encoded = features.one_hot_encoder(spark).transform(rows).select(
        vector_to_array("dist_onehot"), vector_to_array("period_onehot")).collect()
    assert [tuple(map(list, r)) for r in encoded] == [
        ([1, 0, 0, 0, 0, 0, 0], [0, 1, 0, 0, 0, 0]), ([0, 0, 0, 0, 0, 0, 1], [0, 0, 0, 0, 0, 1])]


def test_sixteen_features_in_order(spark):
    rows = spark.createDataFrame([(0.4, -0.5, 2, 1.0, 3)],
                                 "x_center_scaled double, y_center_scaled double, dist_bin int, "
                                 "margin_scaled double, period int")
    vector = features.assembler().transform(
        features.one_hot_encoder(spark).transform(rows)).first().features
    assert list(vector.toArray()) == [0.4, -0.5, 0, 0, 1, 0, 0, 0, 0, 1.0, 0, 0, 0, 1, 0, 0]


def test_missing_input_is_refused(spark):
    rows = spark.createDataFrame([(None, 0.0, 0, 0.0, 1)],
                                 "x_center_scaled double, y_center_scaled double, dist_bin int, "
                                 "margin_scaled double, period int")
    with pytest.raises(Exception, match="null"):
        features.assembler().transform(features.one_hot_encoder(spark).transform(rows)).collect()


def test_string_index_in_place(spark):
    rows = spark.createDataFrame(
        [("b", "x"), ("b", "y"), ("a", "y"), ("c", "y"), (None, "y")], "l string, m string")
    indexed = features.index_in_place(rows, ["l", "m"])
    assert sorted((-1 if r.l is None else r.l, r.m) for r in indexed.collect()) == [
        (-1, 0), (0, 0), (0, 1), (1, 0), (2, 0)]
    known = rows.where("l IS NOT NULL")
    stage = features.string_indexer(["l", "m"]).fit(known).transform(known)
    assert sorted((r.l_index, r.m_index) for r in stage.collect()) == [(0, 0), (0, 1), (1, 0), (2, 0)]


def test_vector_indexer_leaves_continuous_features(planted, spark):
    assembled = features.assembler().transform(features.one_hot_encoder(spark).transform(planted))
    model = features.vector_indexer("features").fit(assembled)
    continuous = set(range(16)) - set(model.categoryMaps)
    assert continuous == {0}


@pytest.mark.parametrize("regressor", [models.forest, models.small_forest, models.boosted])
def test_models_beat_the_mean(planted, regressor):
    model, predicted = training.train_zone_model(planted, regressor())
    fitted = models.regressor_of(model)
    assert fitted.numFeatures == 16
    baseline = evaluate.mean_baseline(planted.where("NOT is_train").drop("prediction"))
    error, mean_error = models.rmse(predicted), evaluate.rmse(baseline).first().rmse
    assert error < 0.75 * mean_error
    assert evaluate.rmse(predicted).first().rmse == pytest.approx(error)
    importances = fitted.featureImportances.toArray()
    assert importances[0] == max(importances)


def test_model_sizes():
    forest, small, boosted = models.forest(), models.small_forest(), models.boosted()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins()) == (20, 5, 32)
    assert (small.getNumTrees(), small.getMaxDepth()) == (15, 4)
    assert (boosted.getMaxIter(), boosted.getStepSize(), boosted.getMaxDepth()) == (10, 0.1, 5)


def predictions(df):
    """Rounded: partial sums may be added in any order."""
    return sorted((r.dist_bin, r.period, r.x_center_scaled, round(r.prediction, 9))
                  for r in df.collect())


def test_same_seed_and_reload_give_the_same_predictions(planted, tmp_path, spark):
    model, predicted = training.train_zone_model(planted, models.forest())
    _, repeated = training.train_zone_model(planted.repartition(5), models.forest())
    assert predictions(predicted) == predictions(repeated)
    _, reseeded = training.train_zone_model(planted, models.forest(seed=1))
    assert predictions(predicted) != predictions(reseeded)
    models.save(model, str(tmp_path / "m"))
    models.save(models.regressor_of(model), str(tmp_path / "forest-only"))
    held_out = planted.where("NOT is_train")
    assert predictions(models.load(str(tmp_path / "m")).transform(held_out)) == predictions(predicted)
    forest = models.load_forest(str(tmp_path / "forest-only"))
    assert (forest.getNumTrees, forest.numFeatures) == (20, 16)


def test_scoring_a_request_table(planted, spark):
    model, _ = training.train_zone_model(planted, models.forest())
    requests = files.requests_from_rows(spark, [
        (0.05, 0.0, 6, 0, 1), (0.9, 0.0, 0, 0, 1), (0.9, 0.0, 0, 9, 8)])
    scored = scoring.score(model, requests)
    assert scored.columns == [*requests.columns, "prediction", "percent"]
    low, high, clamped = scored.orderBy("x_center_scaled", "margin_cat").collect()
    assert 0 <= low.prediction < high.prediction <= 1
    assert high.percent == f"{high.prediction * 100:.1f}%"
    # a late period and a wide margin are brought into range, not refused
    assert (clamped.period, clamped.margin_cat) == (8, 9) and 0 <= clamped.prediction <= 1


def test_requests_that_cannot_be_scored_keep_their_row(planted, spark):
    model, _ = training.train_zone_model(planted, models.small_forest())
    bad = [(None, 0.0, 0, 0, 1), (0.5, float("nan"), 0, 0, 1), (0.5, 0.0, 7, 0, 1),
           (0.5, 0.0, -1, 0, 1), (0.5, 0.0, 0, None, 1), (0.5, 0.0, 0, 0, None), (0.5, 0.0, 0, 0, -1)]
    scored = scoring.score(model, files.requests_from_rows(spark, [*bad, (0.5, 0.0, 0, 0, 1)]))
    assert sum(r.prediction is not None and r.percent is not None for r in scored.collect()) == 1
    assert scored.where("prediction IS NULL AND percent IS NULL").count() == len(bad)


def test_scaled_and_indexed_pipeline(planted):
    model, predicted = training.train_cluster_model(planted, models.forest())
    assert [type(stage).__name__ for stage in model.stages] == [
        "OneHotEncoderModel", "VectorAssembler", "MaxAbsScalerModel", "VectorIndexerModel",
        "RandomForestRegressionModel"]
    assert models.rmse(predicted) < 0.1


def test_cluster_rates_count_every_complete_attempt(spark):
    rows = attempts(spark)
    table = learned_zones.cluster_rates(rows, seed=1, k=5, min_support=1)
    kept = rows.where((F.col("loc_y") < 47) & (F.col("defender_distance") < 1000)
                      & F.col("SCOREMARGIN").isin("TIE", "7", "-18"))
    assert table.agg(F.sum("shots")).first()[0] == kept.count()
    assert table.select("x_center", "y_center").distinct().count() == 5
    made = learned_zones.cluster_rates(rows, seed=1, k=5, outcomes="made")
    assert made.agg(F.min("total")).first()[0] == 2


def test_costs_fall_with_k_and_the_rule_finds_the_groups(spark):
    """Four tight groups: a fifth centre saves next to nothing."""
    centres = [(0, 0), (40, 0), (0, 40), (40, 40)]
    rows = [(float(x + dx), float(y + dy), 10) for x, y in centres for dx in range(3) for dy in range(3)]
    points = fixed_order_table(spark.createDataFrame(rows, "loc_x double, loc_y double, weight long"), "points")
    costs = zones.costs_by_k(points, 3, [7, 1, 2, 3, 4, 5, 6, 4])
    found = {r.k: r.cost for r in costs.collect()}
    assert list(found) == [1, 2, 3, 4, 5, 6, 7]
    assert all(found[k] >= found[k + 1] for k in range(1, 7))
    assert found[1] == pytest.approx(sum(w * ((x - 21) ** 2 + (y - 21) ** 2) for x, y, w in rows))
    assert found[4] == pytest.approx(4 * 10 * 12) and zones.chosen_k(costs) == 4
    assert zones.chosen_k(costs, 0.0) == 7 and zones.chosen_k(costs.where("k = 2")) == 2
