"""Cells, rate tables, zones, splits, indexes and scaling on small inputs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyrate.operators import cells as C
from tallyrate.operators import evaluate, indexing, rates, scaling, split, zones
from tallyrate.plans.named_zones import zone_rates

ATTEMPTS = ("index int, period int, action_type string, loc_x int, loc_y int, shot_zone_basic string, "
            "shot_zone_area string, defender_distance double, htm string, vtm string, "
            "SCOREMARGIN string, shot_made_flag int")


def attempts(spark, count=3000, seed=5, hot_share=0.4):
    """Attempts of few zones, a large share of them in one cell; some incomplete."""
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        hot = draw.random() < hot_share
        rows.append((
            i, 1 if hot else draw.randint(1, 7), "Jump Shot", draw.randint(0, 94), draw.randint(0, 50),
            "Mid" if hot else draw.choice(["Mid", "Rim", "Arc"]),
            "Left" if hot else draw.choice(["Left", "Right", None]),
            2.0 if hot else draw.choice([0.5, 4.0, 8.0, 20.0, float("nan"), None]),
            "O", "F", "TIE" if hot else draw.choice(["TIE", "7", "-18", "x", None]),
            draw.randint(0, 1)))
    return spark.createDataFrame(rows, ATTEMPTS)


@pytest.fixture(scope="module")
def celled(spark):
    return C.with_cells(attempts(spark)).cache()


@pytest.fixture(scope="module")
def four_cells(spark):
    """All made, all missed, mixed, and a single attempt."""
    rows = [("made", 1)] * 3 + [("missed", 0)] * 2 + [("mixed", 1), ("mixed", 0), ("mixed", 0)] + [("once", 1)]
    return spark.createDataFrame(rows, "zone string, shot_made_flag int")


def test_both_outcomes(four_cells, rows_of):
    table = rates.rate_table(four_cells, ["zone"], outcomes="both")
    assert rows_of(table.select("zone", "shot_made_flag", "shots", "total", "fg")) == [
        ("made", 1, 3, 3, 1.0), ("missed", 0, 2, 2, 1.0), ("missed", 1, 0, 2, 0.0),
        ("mixed", 0, 2, 3, 0.67), ("mixed", 1, 1, 3, 0.33)]


def test_made_only(four_cells, rows_of):
    table = rates.rate_table(four_cells, ["zone"])
    assert rows_of(table.select("zone", "shots", "total", "fg")) == [
        ("made", 3, 3, 1.0), ("missed", 0, 2, 0.0), ("mixed", 1, 3, 0.33)]
    assert rates.rate_table(four_cells, ["zone"], min_support=1).count() == 4


def test_unknown_outcome_choice(four_cells):
    with pytest.raises(ValueError):
        rates.rate_table(four_cells, ["zone"], outcomes="some")


def test_single_pass_equals_join_form(celled, rows_of):
    outcomes, totals = rates.outcome_counts(celled), rates.totals(celled)
    match = [outcomes[c].eqNullSafe(totals[c]) for c in C.CELL]
    joined = outcomes.join(totals, match).select(*[outcomes[c] for c in C.CELL], C.FLAG, "shots", "total")
    single = rates.counts_with_total(rates.cell_table(celled)).select(*joined.columns)
    assert rows_of(single) == rows_of(joined)


def test_rate_table_properties(celled):
    complete = C.drop_incomplete(celled, ("dist_bin", "margin_cat", "period"))
    table = rates.rate_table(complete, outcomes="both").collect()
    sums, made = {}, {}
    for row in table:
        cell = tuple(row[c] for c in C.CELL)
        sums.setdefault(cell, []).append((row.shots, row.total))
        made[cell] = made.get(cell, 0) + row.shot_made_flag
        assert 0 <= row.fg <= 1
    assert all(sum(s for s, _ in pairs) == pairs[0][1] >= 2 for pairs in sums.values())
    assert set(made.values()) == {1}


def test_derived_columns_stay_in_range(celled):
    bounds = celled.agg(F.max("x_half"), F.min("dist_bin"), F.max("dist_bin"), F.min("margin_cat"),
                        F.max("margin_cat"), F.max("period")).first()
    assert tuple(bounds) == (47, 0, 6, -3, 1, 5)


def test_half_court_filter_drops_missing(spark):
    df = spark.createDataFrame([(46,), (47,), (None,)], "loc_y int")
    assert [r.loc_y for r in C.in_half_court(df).collect()] == [46]


def test_incomplete_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "c")], "a int, b string")
    assert tuple(C.incomplete_counts(df, ["a", "b"]).first()) == (3, 2, 1, 2)
    assert C.drop_incomplete(df, ["a", "b"]).count() == 1


def test_centroids_from_cells_equal_centroids_from_attempts(celled, rows_of):
    counted = rates.cell_table(celled, C.CELL, ("x_half", "y_half"))
    digits = [F.round("x_center", 9), F.round("y_center", 9)]
    assert rows_of(zones.centroids_of_counts(counted).select("zone", *digits)) == rows_of(
        zones.zone_centroids(celled).select("zone", *digits))


def test_centroid_join_with_and_without_broadcast(celled, rows_of, settings):
    def joined():
        return zones.join_centroids(celled.select("index", "zone"), zones.zone_centroids(celled))
    small = joined()
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    large = joined()
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    assert rows_of(small) == rows_of(large)
    assert large.count() == celled.count()


def test_weighted_clusters_assign_the_nearest_centre(spark):
    located = attempts(spark).select("index", "loc_x", "loc_y")
    model = zones.fit_zones(zones.location_points(located), seed=3, k=6)
    placed = zones.assign_zones(located, model).collect()
    assert len(placed) == located.count()
    centres = {(r.shot_zone, r.x_center, r.y_center) for r in placed}
    assert len(centres) == 6

    def distance(row, x, y):
        return (row.loc_x - x) ** 2 + (row.loc_y - y) ** 2
    for row in placed:
        nearest = min(distance(row, x, y) for _, x, y in centres)
        assert distance(row, row.x_center, row.y_center) == pytest.approx(nearest)


def test_dense_index_over_many_partitions(spark):
    values = random.Random(1).sample(range(10_000), 2_000)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    numbered = {r.v: r["index"] for r in indexing.dense_index(df, [F.col("v").desc()]).collect()}
    assert numbered == {v: i for i, v in enumerate(sorted(values, reverse=True))}


def test_frequency_index_breaks_ties_by_label(spark):
    labels = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + ["d", None, None]
    df = spark.createDataFrame([(label,) for label in labels], "label string")
    ranked = {r.label: (r.n, r["index"]) for r in indexing.frequency_index(df, "label").collect()}
    assert ranked == {"c": (5, 0), "a": (3, 1), "b": (3, 2), "d": (1, 3)}


def test_max_abs_scale(spark, rows_of):
    df = spark.createDataFrame([(1.0, 0.0), (-4.0, 0.0), (None, 0.0)], "a double, b double")
    assert rows_of(scaling.max_abs_scale(df, ["a", "b"]).select("a_scaled", "b_scaled")) == [
        (None, 0.0), (-1.0, 0.0), (0.25, 0.0)]


def test_split_depends_on_the_key_alone(celled, rows_of):
    keyed = celled.select("index", "zone")
    first = split.with_split(keyed, ["index"], seed=1)
    again = split.with_split(keyed.repartition(9), ["index"], seed=1)
    assert rows_of(first) == rows_of(again)
    train, test = split.split(keyed, ["index"], seed=1)
    assert train.count() + test.count() == keyed.count()
    assert 0.66 < train.count() / keyed.count() < 0.74
    other = split.with_split(keyed, ["index"], seed=2)
    assert rows_of(first) != rows_of(other)
    sides = split.with_split(keyed, ["zone"], seed=1).groupBy("zone").agg(
        F.count_distinct("is_train").alias("n")).collect()
    assert {r.n for r in sides} == {1}


@pytest.mark.parametrize("level", ["attempt", "cell"])
def test_zone_rates_count_every_complete_attempt(spark, level):
    rows = attempts(spark)
    table = zone_rates(rows, 42, ["index"], split_level=level, min_support=1)
    complete = C.drop_incomplete(C.with_cells(rows), ("dist_bin", "margin_cat", "period"))
    assert table.agg(F.sum("total")).first()[0] == complete.count()
    assert table.select("is_train").distinct().count() == 2
    supported = zone_rates(rows, 42, ["index"], split_level=level)
    assert supported.agg(F.min("total")).first()[0] == 2


def test_zone_rates_options(spark):
    rows = attempts(spark)
    both = zone_rates(rows, 42, ["index"], outcomes="both")
    assert {r[0] for r in both.select("shot_made_flag").distinct().collect()} == {0, 1}
    train_centres = zone_rates(rows, 42, ["index"], centroids_from="train")
    all_centres = zone_rates(rows, 42, ["index"])
    assert train_centres.count() == all_centres.count()
    assert train_centres.exceptAll(all_centres).count() > 0
    with pytest.raises(ValueError):
        zone_rates(rows, 42, ["index"], split_level="row")


def test_a_share_that_empties_a_side_is_refused(spark):
    with pytest.raises(ValueError):
        split.with_split(spark.range(3), ["id"], 1, share=0.0004)
    assert split.with_split(spark.range(3), ["id"], 1, share=0.0).where("is_train").count() == 0


def test_rmse_and_baseline(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0)], "fg double, prediction double")
    assert tuple(evaluate.rmse(df).first()) == (pytest.approx(0.5 ** 0.5), 2)
    assert {r.prediction for r in evaluate.mean_baseline(df.drop("prediction")).collect()} == {0.5}
