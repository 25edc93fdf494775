"""What the plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.test_oracles import CORE_SQL
from tallyrate import adapters
from tallyrate.catalog import property_queries
from tallyrate.operators import matching, rates
from tallyrate.operators.cells import with_cells
from tallyrate.plans import prep

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


RELATIONAL = [name for name in CORE_SQL if name not in (
    *property_queries.QUERIES, "vector_index_values",
    "assemble_features", "vector_index", "max_abs_scale_vector", "vector_element", "vector_from_array",
    "rate_table_roundtrip", "vector_text_rates", "one_hot", "string_index_stage", "label_index_pipeline", "model_roundtrip",
    "learned_zone_totals")]


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for banned in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                   "BroadcastNestedLoopJoin", "UDF("):
        assert banned not in plan


def test_rates_shuffle_once_beyond_the_attempt_join(spark):
    for outcomes in ("made", "both"):
        plan = plan_of(rates.rate_table(with_cells(adapters.attempts(spark, SF)), outcomes=outcomes))
        assert plan.count("Exchange hashpartitioning") == 1
        assert "partial_count" in plan and "Sort" not in plan


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(entry.queries()["filter_half_court"](spark, SF))
    assert "l_discount" not in plan and "p_brand" not in plan
    assert "LessThan(p_size,47)" in plan


def test_sql_functions_are_inlined(spark):
    plan = plan_of(entry.queries()["sql_function_surface"](spark, SF))
    assert "clamp_margin(" not in plan and "CASE WHEN" in plan


def test_scalar_maxima_share_one_aggregate(spark):
    plan = plan_of(entry.queries()["max_abs_scale"](spark, SF))
    assert "functions=[max(abs(loc_x" in plan.replace("\n", "")
    assert optimized(entry.queries()["max_abs_scale"](spark, SF)).count("scalar-subquery") >= 1


def final_plan(df) -> str:
    query = df._jdf.queryExecution()
    query.toRdd().count()
    return query.executedPlan().toString()


@pytest.fixture
def shuffled_joins(settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16kb",
             spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
             spark__sql__adaptive__advisoryPartitionSizeInBytes="16kb",
             spark__sql__shuffle__partitions="16")


def hot_rows(spark, count=60_000):
    """A third of all rows under one key."""
    return spark.range(0, count, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).cast("string").alias("k"),
        F.col("id").alias("n"))


def test_a_hot_key_is_split_in_the_left_join(spark, shuffled_joins):
    rows = hot_rows(spark)
    lookup = rows.where("n % 7 = 0").select("k", (F.col("n") % 2).cast("string").alias("v"))
    joined = matching.attach(rows, lookup, "k", "v")
    assert "skew=true" in final_plan(joined)
    expected = rows.join(lookup.groupBy("k").count(), "k", "left").agg(
        F.sum(F.coalesce("count", F.lit(1)))).first()[0]
    assert joined.count() == expected


def test_a_hot_time_is_split_when_margins_are_merged(spark, shuffled_joins):
    clock = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    attempts = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("index"), F.lit(1).alias("game_id"), F.lit(1).alias("period"),
        clock.alias("minutes_remaining"), F.lit(30).alias("seconds_remaining"), F.lit("O").alias("htm"))
    log = spark.range(0, 60_000, 2, 8).select(
        F.lit("001").alias("GAME_ID"), F.col("id").alias("EVENTNUM"), F.lit(1).alias("PERIOD"),
        F.concat(F.when(F.col("id") % 4 == 0, F.lit(0)).otherwise(F.col("id")).cast("string"),
                 F.lit(":30")).alias("PCTIMESTRING"),
        F.lit("7").alias("SCOREMARGIN"), F.lit("MISS user").alias("HOMEDESCRIPTION"),
        F.lit(None).cast("string").alias("VISITORDESCRIPTION"), F.lit(1).alias("EVENTMSGACTIONTYPE"))
    margins = prep.subject_margins(attempts, log, "user", "O")
    at_zero = log.where("PCTIMESTRING = '0:30'").count()
    assert margins.where("TIME = '001:1:0:30'").count() == at_zero == 15_000
    few = margins.where("TIME <> '001:1:0:30'")
    merged = prep.merge_margins(attempts, few)
    assert "skew=true" in final_plan(merged)
    assert merged.count() == 60_000


def test_a_hot_key_is_split_in_the_semi_join(spark, shuffled_joins):
    rows = hot_rows(spark)
    kept = matching.with_known_keys(rows, rows.where("n % 6 = 0"), "k")
    assert "skew=true" in final_plan(kept)
    assert kept.count() == 20_000


def test_a_hot_part_is_split_in_the_attempt_join(spark, shuffled_joins, tmp_path):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    hot = lines.select("*", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("_copy")).withColumn(
        "l_partkey", F.when(F.col("_copy") < 4, F.lit(1).cast("bigint")).otherwise(F.col("l_partkey")))
    hot.drop("_copy").repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.read.parquet(f"{SF}/part.parquet").write.parquet(str(tmp_path / "part.parquet"))
    table = rates.rate_table(with_cells(adapters.attempts(spark, str(tmp_path))), min_support=1)
    assert "skew=true" in final_plan(table)
    assert table.agg(F.sum("total")).first()[0] == lines.count() * 6
