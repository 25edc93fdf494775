"""Queries over the event logs, and over text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrate import adapters
from tallyrate.functions import scalars as S
from tallyrate.operators import cells, fill, matching, text
from tallyrate.plans import prep

QUERIES = {}

events = adapters.events


def query(function):
    QUERIES[function.__name__] = function
    return function


def _time_margins(log):
    """(time, margin) of the events that describe a counted attempt."""
    return matching.either_side_matches(
        matching.without_codes(log, "actioncode"), "homedescription", "visitordescription",
    ).select("time", "scoremargin")


@query
def forward_fill(spark, sf_dir):
    log = events(spark, sf_dir).select("game_id", "eventnum", "scoremargin")
    return fill.forward_fill(log, "scoremargin", "game_id", "eventnum")


@query
def forward_fill_large_groups(spark, sf_dir):
    """All events as the log of one huge game."""
    log = events(spark, sf_dir).select(F.lit(1).alias("season"), "eventnum", "scoremargin")
    return fill.forward_fill(log, "scoremargin", "season", "eventnum")


@query
def time_key(spark, sf_dir):
    game = F.concat(F.lit("00"), F.col("game_id").cast("string"))
    return events(spark, sf_dir).select(
        "eventnum",
        S.attempt_time_key(F.col("game_id"), F.col("period"), F.col("minutes_remaining"),
                           F.col("seconds_remaining")).alias("attempt_time"),
        S.log_time_key(game, F.col("period"), adapters.clock()).alias("log_time"))


@query
def url_per_key(spark, sf_dir):
    games = events(spark, sf_dir).select("game_id").distinct()
    return games.select("game_id", S.url_for_key(
        F.col("game_id"), "http://stats.example/plays?game=", "&start=0&end=0",
        prefix="00").alias("url"))


@query
def events_for_subject(spark, sf_dir):
    own_side = matching.subject_side(adapters.SUBJECT, F.col("htm") == adapters.TEAM,
                                     "homedescription", "visitordescription")
    return events(spark, sf_dir).where(own_side).select(
        "eventnum", "htm", "homedescription", "visitordescription")


@query
def exclude_codes(spark, sf_dir):
    return matching.without_codes(events(spark, sf_dir), "actioncode").select(
        "eventnum", "actioncode")


@query
def regex_either_side(spark, sf_dir):
    return matching.either_side_matches(
        events(spark, sf_dir), "homedescription", "visitordescription").select(
        "eventnum", "homedescription", "visitordescription")


@query
def first_attr_per_game(spark, sf_dir):
    log = events(spark, sf_dir)
    first_team = matching.first_per_game(log, "htm", "game_id", "eventnum")
    first_clock = matching.first_per_game(log, "minutes_remaining", "game_id", "eventnum")
    return first_team.join(first_clock, "game_id")


@query
def semi_join_time(spark, sf_dir):
    log = adapters.with_minute_key(events(spark, sf_dir))
    return matching.with_known_keys(log, log.where(F.col("value") > 50), "time").select(
        "eventnum", "time")


@query
def left_join_margin(spark, sf_dir):
    log = adapters.with_minute_key(events(spark, sf_dir))
    rows = log.where(F.col("value") > 50).select("eventnum", "time")
    return matching.attach(rows, _time_margins(log), "time", "scoremargin")


@query
def reconcile_counts(spark, sf_dir):
    log = adapters.with_minute_key(events(spark, sf_dir))
    counted = matching.either_side_matches(log, "homedescription", "visitordescription")
    return matching.differing_counts(log.where(F.col("value") > 50), counted, "game_id")


@query
def match_margins(spark, sf_dir):
    """The whole preparation: fill, filter, match, merge."""
    log = events(spark, sf_dir)
    attempts = adapters.timed_attempts(log)
    margins = prep.subject_margins(attempts, adapters.event_log(log), adapters.SUBJECT,
                                   adapters.TEAM)
    return prep.merge_margins(attempts, margins).select("index", "TIME", "SCOREMARGIN")


@query
def reconcile_margins(spark, sf_dir):
    log = events(spark, sf_dir)
    attempts = adapters.timed_attempts(log)
    margins = prep.subject_margins(attempts, adapters.event_log(log), adapters.SUBJECT,
                                   adapters.TEAM)
    return prep.reconcile(attempts, margins)


@query
def incomplete_counts(spark, sf_dir):
    return cells.incomplete_counts(events(spark, sf_dir), ["scoremargin", "actioncode"])


@query
def text_contains_counts(spark, sf_dir):
    counts = [
        text.contains_counts(text.lines_of(adapters.table(spark, sf_dir, name), column), "ab")
        .select(F.lit(name).alias("source"), "lines_with_a", "lines_with_b")
        for name, column in (("documents", "text"), ("pages", "html"))
    ]
    return counts[0].unionByName(counts[1])
