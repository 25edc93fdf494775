"""Zone centres: means of named zones, or learned by k-means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CLUSTERS = 20
# The share of the first cost that another centre must save to be worth it.
LEAST_GAIN = 0.02


def zone_centroids(cells: DataFrame) -> DataFrame:
    return cells.groupBy("zone").agg(
        F.avg("x_half").alias("x_center"), F.avg("y_half").alias("y_center"))


def centroids_of_counts(counted: DataFrame) -> DataFrame:
    """The same centres from a cell table that carries coordinate sums and
    counts, without touching the attempts again."""
    return counted.groupBy("zone").agg(
        (F.sum("sum_x_half") / F.sum("count_x_half")).alias("x_center"),
        (F.sum("sum_y_half") / F.sum("count_y_half")).alias("y_center"))


def join_centroids(rows: DataFrame, centroids: DataFrame) -> DataFrame:
    """Attach each zone's centre. Adaptive execution measures the centres as they are made and
    broadcasts them while they are small."""
    return rows.join(centroids, "zone")


def location_points(attempts: DataFrame) -> DataFrame:
    """Distinct locations with their weight. Clustering weighted points has the
    same objective as clustering the attempts, at the size of the court."""
    return attempts.groupBy("loc_x", "loc_y").agg(F.count(F.lit(1)).alias("weight"))


def location_vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=["loc_x", "loc_y"], outputCol="location",
                           handleInvalid="error").transform(rows)


def fit_zones(points: DataFrame, seed: int, k: int = CLUSTERS) -> KMeansModel:
    kmeans = KMeans(k=k, seed=seed, featuresCol="location", weightCol="weight",
                    predictionCol="shot_zone")
    return kmeans.fit(location_vectors(points))


def cost_of(points: DataFrame, seed: int, k: int) -> float:
    """Weighted sum of squared distances of the points to the nearest of k fitted centres; a single
    centre is their mean."""
    if k == 1:
        middle = points.agg(*((F.sum(F.col(name) * F.col("weight")) / F.sum("weight")).alias(name) for name in ("loc_x", "loc_y")))
        x, y = middle.first()
        square = (F.col("loc_x") - F.lit(x)) ** 2 + (F.col("loc_y") - F.lit(y)) ** 2
        return points.agg(F.sum(square * F.col("weight"))).first()[0]
    return float(fit_zones(points, seed, k).summary.trainingCost)


def costs_by_k(points: DataFrame, seed: int, ks: Sequence[int]) -> DataFrame:
    """k, cost: the least cost found with at most k centres, for each k.

    All fits read the one table of weighted locations, which should be stored. A fit may end in a
    worse place than one with fewer centres; the smaller one is then a solution for k as well, so
    the cost never rises with k.
    """
    found, least = [], float("inf")
    for k in sorted(set(ks)):
        least = min(least, cost_of(points, seed, k))
        found.append((k, least))
    return points.sparkSession.createDataFrame(found, "k int, cost double")


def chosen_k(costs: DataFrame, least_gain: float = LEAST_GAIN) -> int:
    """The stopping rule: the smallest k whose successor in the table lowers the cost by less
    than `least_gain` of the cost at the smallest k; the largest k where each step gains more."""
    ordered = Window.orderBy("k")
    steps = costs.select("k", (F.col("cost") - F.lead("cost").over(ordered)).alias("gain"),
                         F.first("cost").over(ordered).alias("whole"))
    enough = steps.where(F.col("gain").isNull() | (F.col("gain") < least_gain * F.col("whole")))
    return enough.agg(F.min("k")).first()[0]


def centers_table(model: KMeansModel, like: DataFrame) -> DataFrame:
    """The model's k centres as rows, indexed by cluster."""
    rows = [(index, float(x), float(y)) for index, (x, y) in enumerate(model.clusterCenters())]
    return like.sparkSession.createDataFrame(rows, "shot_zone int, x_center double, y_center double")


def assign_zones(rows: DataFrame, model: KMeansModel) -> DataFrame:
    """Cluster of each row, with its centre. There are exactly k centre rows."""
    placed = model.transform(location_vectors(rows)).drop("location")
    return placed.join(F.broadcast(centers_table(model, rows)), "shot_zone")
