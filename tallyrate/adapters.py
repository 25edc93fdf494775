"""The test tables seen as attempts and event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEAM = "O"
SUBJECT = "user"
# The test tables' brands, which stand for the first part of a zone's name.
BRANDS = tuple(f"Brand#{i}{j}" for i in range(1, 6) for j in range(1, 6))
ACTION_RULES = (("gear", "Gear"), ("ring", "Ring"), ("cold", "Cold"), ("hot", "Hot"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part as attempts.

    No join hint: both sides are plain scans, so Spark broadcasts `part` while
    it is small and otherwise splits the hot part keys of the shuffle join.
    """
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    margin = F.col("l_orderkey") % 61 - 30
    return lines.select(
        F.col("l_orderkey").alias("attempt_key"),
        F.col("l_linenumber").cast("int").alias("period"),
        (F.floor("l_extendedprice").cast("bigint") % 95).cast("int").alias("loc_x"),
        F.col("p_size").cast("int").alias("loc_y"),
        F.concat("p_name", F.lit(" "), "p_type").alias("action_type"),
        F.col("p_brand").alias("shot_zone_basic"),
        F.col("p_type").alias("shot_zone_area"),
        (F.col("l_discount") * 200).alias("defender_distance"),
        F.when(margin == 0, F.lit("TIE")).otherwise(margin.cast("string")).alias("scoremargin"),
        F.col("l_linestatus").alias("htm"),
        F.when(F.col("l_linestatus") == "O", F.lit("F")).otherwise(F.lit("O")).alias("vtm"),
        F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0)).alias("shot_made_flag"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events as the event logs of games, one game per user."""
    number = F.regexp_extract("props", "([0-9]+)", 1)
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("game_id"),
        F.col("event_id").alias("eventnum"),
        (F.dayofmonth("ts") % 4 + 1).cast("int").alias("period"),
        F.minute("ts").alias("minutes_remaining"),
        F.second("ts").alias("seconds_remaining"),
        F.when(kind.isin("purchase", "signup"), number).alias("scoremargin"),
        F.when(kind != "view", number.cast("int") % 20).alias("actioncode"),
        F.when(kind == "click", F.lit("MISS user shot"))
         .when(kind == "purchase", F.lit("user (3 PTS)"))
         .when(kind == "error", F.lit("user FOUL")).alias("homedescription"),
        F.when(kind == "signup", F.lit("user 2 PTS"))
         .when(kind == "view", F.lit("MISSED")).alias("visitordescription"),
        F.when(F.col("user_id") % 2 == 0, F.lit("O")).otherwise(F.lit("F")).alias("htm"),
        "value",
    )


def with_minute_key(log: DataFrame) -> DataFrame:
    """A coarse time key, to the minute, so that several events share a key."""
    minute = F.lpad(F.col("minutes_remaining").cast("string"), 2, "0")
    return log.withColumn("time", F.concat(
        F.lit("00"), F.col("game_id").cast("string"), F.lit(":"), F.col("period").cast("string"),
        F.lit(":"), minute))


def timed_attempts(log: DataFrame) -> DataFrame:
    """The events that count as attempts, in attempt columns."""
    return log.where(F.col("value") > 50).select(
        F.col("eventnum").alias("index"), "game_id", "period", "minutes_remaining",
        "seconds_remaining", "htm")


def clock() -> Column:
    """The clock as `m:ss`."""
    seconds = F.lpad(F.col("seconds_remaining").cast("string"), 2, "0")
    return F.concat(F.col("minutes_remaining").cast("string"), F.lit(":"), seconds)


def event_log(log: DataFrame) -> DataFrame:
    """The events in event-log columns."""
    return log.select(
        F.concat(F.lit("00"), F.col("game_id").cast("string")).alias("GAME_ID"),
        F.col("eventnum").alias("EVENTNUM"),
        F.col("period").alias("PERIOD"),
        clock().alias("PCTIMESTRING"),
        F.col("scoremargin").alias("SCOREMARGIN"),
        F.col("homedescription").alias("HOMEDESCRIPTION"),
        F.col("visitordescription").alias("VISITORDESCRIPTION"),
        F.col("actioncode").alias("EVENTMSGACTIONTYPE"),
    )


def result_set_documents(log: DataFrame, rows: int = 500, by_game: bool = True) -> DataFrame:
    """An event log as result-set documents. A document covers at most `rows`
    consecutive event numbers of a game, or of all games, so none grows with its game."""
    ordered = F.sort_array(F.collect_list(F.struct(
        F.col("EVENTNUM"), F.array(*[F.col(name).cast("string") for name in log.columns])
        .alias("cells"))))
    keys = ["GAME_ID"] if by_game else []
    return log.groupBy(*keys, F.floor(F.col("EVENTNUM") / rows)).agg(
        ordered.alias("ordered")).select(F.array(F.struct(
            F.lit("PlayByPlay").alias("name"),
            F.array(*[F.lit(name) for name in log.columns]).alias("headers"),
            F.col("ordered.cells").alias("rowSet"))).alias("resultSets"))
