"""Queries that fit or apply models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrate import adapters
from tallyrate.catalog.attempt_queries import cells
from tallyrate.operators import evaluate, models, zones
from tallyrate.operators.cells import CELL, FLAG
from tallyrate.plans import scoring, training
from tallyrate.plans.learned_zones import CELL as CLUSTER_CELL
from tallyrate.plans.learned_zones import cluster_rates
from tallyrate.plans.named_zones import zone_rates
from tallyrate.sources import files
from tallyrate.storage import fixed_order_table, fresh_path

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _zone_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_rates(adapters.attempts(spark, sf_dir), models.SEED, ["attempt_key"])


def _importances(model) -> DataFrame:
    """One row per feature of a fitted tree ensemble."""
    fitted = models.regressor_of(model)
    rows = [(index, float(value), fitted.getNumTrees)
            for index, value in enumerate(fitted.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature int, importance double, trees int")


@query
def zone_centers_kmeans(spark, sf_dir):
    located = adapters.attempts(spark, sf_dir).where(F.col("loc_y") < 47).select(
        "attempt_key", "loc_x", "loc_y")
    points = fixed_order_table(zones.location_points(located), "points")
    return zones.assign_zones(located, zones.fit_zones(points, models.SEED))


@query
def learned_zone_rates(spark, sf_dir):
    return cluster_rates(adapters.attempts(spark, sf_dir), models.SEED)


@query
def learned_zone_totals(spark, sf_dir):
    """Totals over all learned zones: clustering moves every attempt, and loses none."""
    rated = cluster_rates(adapters.attempts(spark, sf_dir), models.SEED, min_support=1,
                          outcomes="made")
    return rated.groupBy("dist_bin", "margin_cat", "period").agg(
        F.sum("total").alias("total"), F.sum("shots").alias("shots"))


@query
def train_forest(spark, sf_dir):
    model, _ = training.train_zone_model(_zone_rates(spark, sf_dir), models.forest())
    return _importances(model)


@query
def train_forest_small(spark, sf_dir):
    model, _ = training.train_zone_model(_zone_rates(spark, sf_dir), models.small_forest())
    return _importances(model)


@query
def train_gbt(spark, sf_dir):
    model, _ = training.train_zone_model(_zone_rates(spark, sf_dir), models.boosted())
    return _importances(model)


@query
def predict_holdout(spark, sf_dir):
    _, predicted = training.train_zone_model(_zone_rates(spark, sf_dir), models.forest())
    return predicted.select(*CELL, "shots", "total", "fg", "prediction")


@query
def evaluate_models(spark, sf_dir):
    rates = fixed_order_table(_zone_rates(spark, sf_dir), "rates")
    rows = []
    for name, regressor in (("forest", models.forest()), ("small_forest", models.small_forest()),
                            ("boosted", models.boosted())):
        _, predicted = training.fit_and_predict(rates, models.pipeline(spark, regressor))
        rows.append(evaluate.rmse(predicted).withColumn("model", F.lit(name)))
    return reduce(DataFrame.unionByName, rows).select("model", "rmse", "n")


@query
def train_learned_zones(spark, sf_dir):
    """Learned zones, both outcomes, scaled and indexed: held-out predictions."""
    rates = cluster_rates(adapters.attempts(spark, sf_dir), models.SEED)
    _, predicted = training.train_cluster_model(rates, models.forest())
    return predicted.select(*CLUSTER_CELL, FLAG, "shots", "total", "fg", "prediction")


@query
def train_from_rate_table(spark, sf_dir):
    """Train from a rate table read back from files."""
    path = fresh_path(spark, "rate-table")
    files.write_rates(cluster_rates(adapters.attempts(spark, sf_dir), models.SEED), path)
    _, predicted = training.train_cluster_model(files.read_rates(spark, path), models.forest())
    return predicted.select(*CLUSTER_CELL, FLAG, "fg", "prediction")


@query
def model_roundtrip(spark, sf_dir):
    """Held-out cells, and whether the reloaded model predicts as the fitted one."""
    model, predicted = training.train_zone_model(_zone_rates(spark, sf_dir), models.forest())
    path = fresh_path(spark, "model")
    models.save(model, path)
    again = models.load(path).transform(predicted.select(
        *CELL, "fg", "x_center_scaled", "y_center_scaled", "margin_scaled",
        F.col("prediction").alias("fitted")))
    return again.select(*CELL, "fg", (F.col("fitted") == F.col("prediction")).alias("same_prediction"))


@query
def score_requests(spark, sf_dir):
    model, _ = training.train_zone_model(_zone_rates(spark, sf_dir), models.forest())
    path = fresh_path(spark, "model")
    models.save(model, path)
    return scoring.score(models.load(path), scoring.requests_of(cells(spark, sf_dir)))
