"""Explicit schemas, so that no scan needs an inference pass."""

from __future__ import annotations

from pyspark.sql import types as T

ATTEMPTS = T.StructType([
    T.StructField("index", T.IntegerType()),
    T.StructField("game_id", T.IntegerType()),
    T.StructField("period", T.IntegerType()),
    T.StructField("minutes_remaining", T.IntegerType()),
    T.StructField("seconds_remaining", T.IntegerType()),
    T.StructField("action_type", T.StringType()),
    T.StructField("loc_x", T.DoubleType()),
    T.StructField("loc_y", T.DoubleType()),
    T.StructField("shot_zone_basic", T.StringType()),
    T.StructField("shot_zone_area", T.StringType()),
    T.StructField("defender_id", T.StringType()),
    T.StructField("defender_distance", T.DoubleType()),
    T.StructField("htm", T.StringType()),
    T.StructField("vtm", T.StringType()),
    T.StructField("SCOREMARGIN", T.StringType()),
    T.StructField("shot_made_flag", T.IntegerType()),
])

# Event-log fields used from a result set, with the type each cell is cast to.
EVENTS = T.StructType([
    T.StructField("GAME_ID", T.StringType()),
    T.StructField("EVENTNUM", T.LongType()),
    T.StructField("PERIOD", T.IntegerType()),
    T.StructField("PCTIMESTRING", T.StringType()),
    T.StructField("SCOREMARGIN", T.StringType()),
    T.StructField("HOMEDESCRIPTION", T.StringType()),
    T.StructField("VISITORDESCRIPTION", T.StringType()),
    T.StructField("EVENTMSGACTIONTYPE", T.IntegerType()),
])

RESULT_SET_DOCUMENT = T.StructType([
    T.StructField("resultSets", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("headers", T.ArrayType(T.StringType())),
        T.StructField("rowSet", T.ArrayType(T.ArrayType(T.StringType()))),
    ]))),
])

# Requests to a model of learned zones, in raw coordinates; periods are not clamped.
RAW_REQUESTS = T.StructType([
    T.StructField("x_center", T.DoubleType()),
    T.StructField("y_center", T.DoubleType()),
    T.StructField("dist_bin", T.IntegerType()),
    T.StructField("margin_cat", T.IntegerType()),
    T.StructField("period", T.IntegerType()),
])

REQUESTS = T.StructType([
    T.StructField("x_center_scaled", T.DoubleType()),
    T.StructField("y_center_scaled", T.DoubleType()),
    T.StructField("dist_bin", T.IntegerType()),
    T.StructField("margin_cat", T.IntegerType()),
    T.StructField("period", T.IntegerType()),
])
