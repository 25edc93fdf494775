"""What must hold of any fit, in a form that SQL can state: keys, ranges and equalities.

The fitted results themselves are the queries of `model_queries`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrate import adapters
from tallyrate.catalog import model_queries as M
from tallyrate.catalog.attempt_queries import cells
from tallyrate.catalog.oracles import CELL as CELL_SQL
from tallyrate.catalog.oracles import PCT2, _attempts, _bucket, _cells
from tallyrate.functions import scalars as S
from tallyrate.operators import evaluate, models, trees, zones
from tallyrate.operators.cells import CELL, FLAG
from tallyrate.plans import learned_zones, scoring, training
from tallyrate.storage import fixed_order_table, written_table

QUERIES = {}
ORACLES = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function
    return register


HELD_OUT = _cells(f"""
    , marked as (select *, {_bucket('attempt_key')} < 700 as is_train from cells),
    counted as (
      select {CELL_SQL}, cast(sum(shot_made_flag) as bigint) as shots, count(*) as total
      from marked where not is_train group by all having count(*) >= 2
    )""")


def _with_label_range(predicted: DataFrame, rates: DataFrame) -> DataFrame:
    """Whether predictions lie between the least and largest label the fit saw; a mean of trees
    cannot leave that range."""
    low, high = rates.where("is_train").agg(F.min("fg"), F.max("fg")).first()
    return predicted.withColumn("in_range", F.col("prediction").between(low - 1e-9, high + 1e-9))


@query("""select * from (values ('forest', 16::bigint, 20, 1.0::double), ('small_forest', 16, 15, 1.0),
                                ('boosted', 16, 10, 1.0)) as t(model, features, trees, importance)""")
def trained_models(spark, sf_dir):
    rates = written_table(M._zone_rates(spark, sf_dir), "rates")
    rows = []
    for name, regressor in (("forest", models.forest()), ("small_forest", models.small_forest()),
                            ("boosted", models.boosted())):
        model, _ = training.train_zone_model(rates, regressor)
        rows.append(M._importances(model).groupBy("trees").agg(
            F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("importance"))
            .withColumn("model", F.lit(name)))
    return reduce(DataFrame.unionByName, rows).select("model", "features", "trees", "importance")


@query(f"{HELD_OUT} select {CELL_SQL}, shots, total, {PCT2.format('shots', 'total')} as fg, true as in_range from counted")
def held_out_predictions(spark, sf_dir):
    rates = written_table(M._zone_rates(spark, sf_dir), "rates")
    _, predicted = training.train_zone_model(rates, models.forest())
    return _with_label_range(predicted, rates).select(*CELL, "shots", "total", "fg", "in_range")


def _compiled(spark, sf_dir, regressor):
    """Held-out cells, and whether the model as one SQL expression predicts what the model does."""
    rates = written_table(M._zone_rates(spark, sf_dir), "rates")
    model, predicted = training.train_zone_model(rates, regressor)
    both = trees.with_prediction(predicted, model, "compiled")
    return both.select(*CELL, "shots", "total", "fg",
                       (F.abs(F.col("compiled") - F.col("prediction")) <= 1e-9).alias("same_prediction"))


COMPILED_SQL = f"{HELD_OUT} select {CELL_SQL}, shots, total, {PCT2.format('shots', 'total')} as fg, true as same_prediction from counted"


@query(COMPILED_SQL)
def forest_predictions_sql(spark, sf_dir):
    return _compiled(spark, sf_dir, models.forest())


@query(COMPILED_SQL)
def boosted_predictions_sql(spark, sf_dir):
    return _compiled(spark, sf_dir, models.boosted())


@query(f"""{HELD_OUT.replace('where not is_train', 'where is_train')}
    select count(*) as n, round(sum({PCT2.format('shots', 'total')}), 4) as labels, true as leaves_are_means from counted""")
def boosted_leaf_means(spark, sf_dir):
    """The first tree of a boosted fit splits the training cells and holds their means: numbers and label
    sums of its leaves, and whether cells routed by the expression agree with each leaf."""
    rates = written_table(M._zone_rates(spark, sf_dir), "rates")
    model, _ = training.train_zone_model(rates, models.boosted(iterations=1))
    leaves = trees.nodes(models.regressor_of(model)).where("feature is null").select(F.col("node").alias("leaf"), "n", "value")
    routed = trees.with_leaf(rates.where("is_train"), model, 0).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("cells"), F.avg("fg").alias("mean"))
    agrees = (F.col("n") == F.col("cells")) & (F.abs(F.col("value") - F.col("mean")) <= 1e-9)
    return leaves.join(routed, "leaf", "full").agg(
        F.sum("n").alias("n"), F.round(F.sum(F.col("n") * F.col("value")), 4).alias("labels"),
        F.min(F.coalesce(agrees, F.lit(False))).alias("leaves_are_means"))


@query("select unnest(range(0, 20))::integer as tree, true as two_children, true as rows_kept, true as means_kept")
def forest_node_rules(spark, sf_dir):
    """Of each tree of a forest: an inner node has two children, whose rows and label sums are its own."""
    model, _ = training.train_zone_model(M._zone_rates(spark, sf_dir), models.forest())
    table = written_table(trees.nodes(models.regressor_of(model)), "nodes")
    child = table.select("tree", F.col("node").alias("child"), F.col("n").alias("child_n"), (F.col("n") * F.col("value")).alias("child_sum"))
    inner = table.where("feature is not null").select(
        "tree", "node", "n", "value", F.explode(F.array("left", "right")).alias("child"))
    sums = inner.join(child, ["tree", "child"]).groupBy("tree", "node", "n", "value").agg(
        F.count(F.lit(1)).alias("children"), F.sum("child_n").alias("rows"), F.sum("child_sum").alias("sum"))
    return sums.groupBy("tree").agg(
        F.min(F.col("children") == 2).alias("two_children"), F.min(F.col("rows") == F.col("n")).alias("rows_kept"),
        F.min(F.abs(F.col("sum") - F.col("n") * F.col("value")) <= 1e-6 * (1 + F.col("n"))).alias("means_kept"))


@query(f"""{HELD_OUT} select m as model, (select count(*) from counted) as n, true as finite, true as same
           from (values ('forest'), ('small_forest'), ('boosted')) as t(m)""")
def evaluated_models(spark, sf_dir):
    rates = fixed_order_table(M._zone_rates(spark, sf_dir), "rates")
    rows = []
    for name, regressor in (("forest", models.forest()), ("small_forest", models.small_forest()),
                            ("boosted", models.boosted())):
        _, predicted = training.fit_and_predict(rates, models.pipeline(spark, regressor))
        predicted = written_table(predicted.select("fg", "prediction"), "predicted")
        again = models.rmse(predicted)
        rows.append(evaluate.rmse(predicted).select(
            F.lit(name).alias("model"), "n", F.col("rmse").between(0, 1).alias("finite"),
            (F.abs(F.col("rmse") - again) < 1e-9).alias("same")))
    return reduce(DataFrame.unionByName, rows)


@query(_attempts("select attempt_key, loc_x, loc_y, true as nearest from attempts_v where loc_y < 47"))
def nearest_learned_zones(spark, sf_dir):
    located = adapters.attempts(spark, sf_dir).where(F.col("loc_y") < 47).select("attempt_key", "loc_x", "loc_y")
    model = zones.fit_zones(fixed_order_table(zones.location_points(located), "points"), models.SEED)
    centres = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
                        for x, y in model.clusterCenters()))
    square = lambda x, y: (x - F.col("loc_x")) ** 2 + (y - F.col("loc_y")) ** 2
    least = F.array_min(F.transform(centres, lambda c: square(c["x"], c["y"])))
    return zones.assign_zones(located, model).select(
        "attempt_key", "loc_x", "loc_y",
        (square(F.col("x_center"), F.col("y_center")) <= least + 1e-9).alias("nearest"))


@query("select true as supported, true as fitting, true as outcomes, 20::bigint as centres")
def learned_zone_rules(spark, sf_dir):
    rates = learned_zones.cluster_rates(adapters.attempts(spark, sf_dir), models.SEED)
    return rates.agg(
        F.min(F.col("total") >= 2).alias("supported"),
        F.min((F.col("shots") <= F.col("total")) & (F.col("fg") == S.pct2(F.col("shots"), F.col("total")))).alias("fitting"),
        F.min(F.col(FLAG).isin(0, 1)).alias("outcomes"), F.countDistinct("x_center", "y_center").alias("centres"))


@query("select true as in_range, true as held_out, true as all_scored")
def learned_zone_predictions(spark, sf_dir):
    """Train on the cells of learned zones, predict the rest, and score requests at the centres."""
    rates = written_table(learned_zones.cluster_rates(adapters.attempts(spark, sf_dir), models.SEED), "rates")
    model, predicted = training.train_cluster_model(rates, models.forest())
    scored = scoring.score(model, rates.select("x_center", "y_center", "dist_bin", "margin_cat", "period"))
    held_out = rates.where("not is_train").count()
    checked = _with_label_range(predicted, rates).agg(
        F.min("in_range").alias("in_range"), (F.count(F.lit(1)) == held_out).alias("held_out"))
    every = scored.agg(F.min(F.coalesce(F.col("prediction").between(0, 1), F.lit(False)))).first()[0]
    return checked.withColumn("all_scored", F.lit(every))


@query(_cells("""
    select round(x_half / 47, 9) as x_center_scaled, round((y_half - 25) / 25, 9) as y_center_scaled,
           dist_bin, margin_cat, period, true as in_range, true as same_percent from cells"""))
def scored_requests(spark, sf_dir):
    model, _ = training.train_zone_model(M._zone_rates(spark, sf_dir), models.forest())
    scored = scoring.score(model, scoring.requests_of(cells(spark, sf_dir)))
    return scored.select(
        F.round("x_center_scaled", 9).alias("x_center_scaled"), F.round("y_center_scaled", 9).alias("y_center_scaled"),
        "dist_bin", "margin_cat", "period", F.col("prediction").between(0, 1).alias("in_range"),
        (F.abs(F.col("prediction") * 100 - F.regexp_replace("percent", "%", "").cast("double")) <= 0.0501).alias("same_percent"))
