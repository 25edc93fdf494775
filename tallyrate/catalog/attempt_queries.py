"""Queries over the attempts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrate import adapters
from tallyrate.functions import scalars as S
from tallyrate.functions import sql_surface
from tallyrate.operators import evaluate, features, indexing, rates, scaling, zones
from tallyrate.operators.cells import CELL, FLAG, in_half_court, with_cells
from tallyrate.operators.models import SEED
from tallyrate.operators.split import with_split
from tallyrate.plans.named_zones import with_model_inputs, zone_rates
from tallyrate.sources.files import with_constant

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

attempts = adapters.attempts


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_cells(attempts(spark, sf_dir))


# --- rate tables ---------------------------------------------------------------

@query
def success_rate(spark, sf_dir):
    return rates.rate_table(cells(spark, sf_dir)).select(*CELL, "shots", "total", "fg")


@query
def cell_outcome_counts(spark, sf_dir):
    return rates.outcome_counts(cells(spark, sf_dir))


@query
def cell_totals(spark, sf_dir):
    return rates.totals(cells(spark, sf_dir))


@query
def outcome_counts_with_total(spark, sf_dir):
    return rates.counts_with_total(rates.cell_table(cells(spark, sf_dir)))


@query
def rates_min_support(spark, sf_dir):
    return rates.supported(rates.totals(cells(spark, sf_dir)))


@query
def rates_union(spark, sf_dir):
    return rates.rate_table(cells(spark, sf_dir), outcomes="both")


@query
def rates_made_only(spark, sf_dir):
    return rates.rate_table(cells(spark, sf_dir), outcomes="both").where(F.col(FLAG) == 1)


@query
def rates_sorted(spark, sf_dir):
    return rates.rate_table(cells(spark, sf_dir), outcomes="both").orderBy(*CELL, FLAG)


@query
def top_cells(spark, sf_dir):
    return success_rate(spark, sf_dir).orderBy(F.desc("total"), *CELL).limit(20)


@query
def named_zone_rates(spark, sf_dir):
    rated = zone_rates(attempts(spark, sf_dir), SEED, ["attempt_key"])
    return rated.select("is_train", *CELL, "shots", "total", "fg", *[
        F.round(name, 9).alias(name)
        for name in ("x_center_scaled", "y_center_scaled", "margin_scaled")])


@query
def rmse_of_baseline(spark, sf_dir):
    predicted = evaluate.mean_baseline(success_rate(spark, sf_dir))
    return evaluate.rmse(predicted).select(F.round("rmse", 9).alias("rmse"), "n")


# --- zones ---------------------------------------------------------------------

@query
def zone_centroids(spark, sf_dir):
    return _rounded_centres(zones.zone_centroids(cells(spark, sf_dir)))


@query
def zone_centroid_join(spark, sf_dir):
    rows = cells(spark, sf_dir)
    located = rows.select("attempt_key", "zone", "x_half", "y_half")
    return _rounded_centres(zones.join_centroids(located, zones.zone_centroids(rows)))


def _rounded_centres(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.round(name, 9) for name in ("x_center", "y_center")})


@query
def fixed_scale(spark, sf_dir):
    rows = with_model_inputs(cells(spark, sf_dir).withColumnsRenamed(
        {"x_half": "x_center", "y_half": "y_center"}))
    return rows.select("attempt_key", *[F.round(name, 9).alias(name) for name in (
        "x_center_scaled", "y_center_scaled", "margin_scaled")])


@query
def dense_row_index(spark, sf_dir):
    names = cells(spark, sf_dir).select("zone").distinct()
    return indexing.dense_index(names, [F.col("zone")], "zone_index")


# --- filters and scalar functions ------------------------------------------------

@query
def filter_half_court(spark, sf_dir):
    return in_half_court(attempts(spark, sf_dir)).select("attempt_key", "loc_x", "loc_y", FLAG)


@query
def distinct_actions(spark, sf_dir):
    return attempts(spark, sf_dir).select("action_type").distinct()


@query
def tie_to_zero(spark, sf_dir):
    return attempts(spark, sf_dir).select(
        "attempt_key", "scoremargin", S.tie_to_zero(F.col("scoremargin")).alias("score_margin"))


@query
def margin_bucket(spark, sf_dir):
    return attempts(spark, sf_dir).select(
        "attempt_key", S.margin_bucket(S.tie_to_zero(F.col("scoremargin"))).alias("bucket"))


@query
def clamp_margin(spark, sf_dir):
    return attempts(spark, sf_dir).select(
        "attempt_key", S.margin_category(F.col("scoremargin")).alias("margin_cat"))


@query
def clamp_period(spark, sf_dir):
    rows = attempts(spark, sf_dir).withColumnRenamed("period", "played")
    return rows.select("attempt_key", "played", S.clamp_period(F.col("played")).alias("period"))


@query
def distance_bins(spark, sf_dir):
    return attempts(spark, sf_dir).select(
        "attempt_key", "defender_distance",
        S.distance_bin(F.col("defender_distance")).alias("dist_bin"))


@query
def fold_court(spark, sf_dir):
    return cells(spark, sf_dir).select("attempt_key", "loc_x", "loc_y", "x_half", "y_half")


@query
def categorize_first_match(spark, sf_dir):
    return attempts(spark, sf_dir).select(
        "attempt_key", "action_type", _action_category().alias("category"))


def _action_category():
    return S.first_match(F.col("action_type"), adapters.ACTION_RULES)


@query
def pct2(spark, sf_dir):
    """Rate of success of every location, whatever its support."""
    counted = rates.cell_table(attempts(spark, sf_dir), ("loc_x", "loc_y"))
    return rates.made_rates(counted).select("loc_x", "loc_y", "fg")


@query
def percent_text(spark, sf_dir):
    return success_rate(spark, sf_dir).select(*CELL, S.percent_text(F.col("fg")).alias("percent"))


@query
def concat_zone(spark, sf_dir):
    return cells(spark, sf_dir).select("attempt_key", "shot_zone_basic", "shot_zone_area", "zone")


@query
def team_flags(spark, sf_dir):
    return attempts(spark, sf_dir).select(
        "attempt_key", S.indicator(F.col("htm"), adapters.TEAM).alias("h"),
        S.indicator(F.col("vtm"), adapters.TEAM).alias("v"))


@query
def constant_column(spark, sf_dir):
    rows = attempts(spark, sf_dir).select("attempt_key", "period", FLAG)
    return with_constant(rows, "season_type", "Regular")


@query
def sql_function_surface(spark, sf_dir):
    sql_surface.register(spark)
    return spark.sql("""
        SELECT attempt_key,
               tie_to_zero(scoremargin) AS score_margin,
               margin_bucket(tie_to_zero(scoremargin)) AS bucket,
               clamp_margin(margin_bucket(tie_to_zero(scoremargin))) AS margin_cat,
               clamp_period(period) AS period,
               distance_bin(defender_distance) AS dist_bin,
               fold_x(loc_x) AS x_half,
               fold_y(loc_x, loc_y) AS y_half,
               action_category(replace(replace(replace(action_type, 'gear', 'Jump'), 'ring', 'Layup'),
                                       'hot', 'Fadeaway')) AS category,
               pct2(loc_x, loc_x + loc_y + 1) AS share,
               concat_zone(shot_zone_basic, shot_zone_area) AS zone
        FROM {attempts}""", attempts=attempts(spark, sf_dir))


# --- encoding --------------------------------------------------------------------

@query
def frequency_index(spark, sf_dir):
    return indexing.frequency_index(attempts(spark, sf_dir), "shot_zone_basic", "label_index")


@query
def string_index_columns(spark, sf_dir):
    rows = cells(spark, sf_dir).select("attempt_key", "zone", _action_category().alias("category"))
    return features.index_in_place(rows, ["category", "zone"])


@query
def string_index_stage(spark, sf_dir):
    rows = cells(spark, sf_dir).select("attempt_key", _action_category().alias("category"))
    indexed = features.string_indexer(["category"]).fit(rows).transform(rows)
    return indexed.select("attempt_key", "category",
                          F.col("category_index").cast("int").alias("category_index"))


@query
def one_hot(spark, sf_dir):
    counted = rates.totals(cells(spark, sf_dir))
    encoded = features.one_hot_encoder(spark).transform(counted)
    return encoded.select(*CELL, *_elements("dist_onehot", 7, "d"), *_elements("period_onehot", 6, "p"))


@query
def one_hot_flags(spark, sf_dir):
    return cells(spark, sf_dir).select(
        "attempt_key", *features.level_flags("dist_bin", range(7), "d"),
        *features.level_flags("period", range(6), "p"))


@query
def one_hot_labels(spark, sf_dir):
    """Every level of the action category, and of a zone's first name, as 0/1 columns."""
    rows = cells(spark, sf_dir).select("attempt_key", "shot_zone_basic", _action_category().alias("category"))
    labels = [label for _, label in adapters.ACTION_RULES] + [S.ACTION_DEFAULT]
    flagged = features.one_hot_labels(rows, {"category": labels, "shot_zone_basic": adapters.BRANDS})
    return flagged.drop("shot_zone_basic", "category")


def _elements(vector: str, size: int, prefix: str, kind: str = "int") -> list:
    array = vector_to_array(F.col(vector))
    return [array[i].cast(kind).alias(f"{prefix}{i}") for i in range(size)]


def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature vectors of the supported cells, one per cell."""
    rated = zone_rates(attempts(spark, sf_dir), SEED, ["attempt_key"], split_level="cell")
    encoded = features.one_hot_encoder(spark).transform(rated)
    return features.assembler().transform(encoded)


def _vector_columns(rows: DataFrame, vector: str, prefix: str) -> DataFrame:
    values = [F.round(c, 9) for c in _elements(vector, 16, prefix, "double")]
    return rows.select(*CELL, *[v.alias(f"{prefix}{i}") for i, v in enumerate(values)])


@query
def assemble_features(spark, sf_dir):
    return _vector_columns(_assembled(spark, sf_dir), "features", "f")


@query
def vector_index(spark, sf_dir):
    rows = _assembled(spark, sf_dir)
    indexed = features.vector_indexer("features").fit(rows).transform(rows)
    return _vector_columns(indexed, "indexed_features", "f")


@query
def vector_index_values(spark, sf_dir):
    """Features of three and four values become their ranks; one of many values stays."""
    rows = attempts(spark, sf_dir).select(
        "attempt_key", (F.col("loc_x") % 3 * 10 - 5).alias("three"), (F.col("loc_y") % 4 * 7 + 2).alias("four"),
        F.col("loc_x").alias("many"))
    assembled = VectorAssembler(inputCols=["three", "four", "many"], outputCol="features").transform(rows)
    indexed = features.vector_indexer("features").fit(assembled).transform(assembled)
    array = vector_to_array("indexed_features")
    return indexed.select("attempt_key", "three", "four", "many", *(
        array[i].cast("int").alias(f"{name}_index") for i, name in enumerate(("three", "four", "many"))))


@query
def max_abs_scale_vector(spark, sf_dir):
    rows = _assembled(spark, sf_dir)
    scaled = features.max_abs_scaler().fit(rows).transform(rows)
    return _vector_columns(scaled, "scaled_features", "f")


@query
def vector_element(spark, sf_dir):
    rows = _assembled(spark, sf_dir)
    return rows.select(*CELL, S.vector_element(F.col("features"), 0).alias("x"),
                       S.vector_element(F.col("features"), 1).alias("y"))


@query
def vector_from_array(spark, sf_dir):
    """Zone centres as arrays, then vectors, then elements."""
    centres = zones.zone_centroids(cells(spark, sf_dir)).select(
        "zone", array_to_vector(F.array("x_center", "y_center")).alias("centre"))
    return centres.select("zone", S.vector_element(F.col("centre"), 0, 9).alias("x_center"),
                          S.vector_element(F.col("centre"), 1, 9).alias("y_center"))


@query
def max_abs_scale(spark, sf_dir):
    rows = attempts(spark, sf_dir).select(
        "attempt_key", "loc_x", S.tie_to_zero(F.col("scoremargin")).alias("score_margin"))
    scaled = scaling.max_abs_scale(rows, ["loc_x", "score_margin"])
    return scaled.select("attempt_key", *[F.round(name, 9).alias(name) for name in (
        "loc_x_scaled", "score_margin_scaled")])


# --- splits ----------------------------------------------------------------------

@query
def split_attempts(spark, sf_dir):
    rows = attempts(spark, sf_dir).select("attempt_key", FLAG)
    return with_split(rows, ["attempt_key"], SEED)


@query
def split_cells(spark, sf_dir):
    return with_split(success_rate(spark, sf_dir), CELL, SEED)

