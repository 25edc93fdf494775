"""From attempts and event logs to attempts with the score margin at their time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrate.functions import scalars as S
from tallyrate.operators import matching as M
from tallyrate.operators.fill import forward_fill
from tallyrate.storage import written_table

TIME, MARGIN = "TIME", "SCOREMARGIN"


def with_attempt_time(attempts: DataFrame) -> DataFrame:
    return attempts.withColumn(TIME, S.attempt_time_key(
        F.col("game_id"), F.col("period"), F.col("minutes_remaining"), F.col("seconds_remaining")))


def subject_margins(attempts: DataFrame, log: DataFrame, subject: str, team: str) -> DataFrame:
    """Margins at the subject's attempts: GAME_ID, TIME, SCOREMARGIN.

    All games at once. The filters on the log run before its join with the known
    times; a game's side comes along with its times, which are distinct. The
    result is written: it is used for merging and for reconciling, and a join
    whose output goes to files may split a hot time, which it may not when a
    grouping by the same time follows in the same plan.
    """
    timed = with_attempt_time(attempts)
    home_team = written_table(M.first_per_game(attempts, "htm", "game_id", "index"), "home-teams")
    known = timed.select("game_id", TIME).distinct().join(home_team, "game_id").select(
        TIME, (F.col("htm") == team).alias("at_home"))
    filled = forward_fill(log, MARGIN, "GAME_ID", "EVENTNUM")
    counted = M.either_side_matches(M.without_codes(filled, "EVENTMSGACTIONTYPE"),
                                    "HOMEDESCRIPTION", "VISITORDESCRIPTION")
    keyed = counted.withColumn(TIME, S.log_time_key(
        F.col("GAME_ID"), F.col("PERIOD"), F.col("PCTIMESTRING")))
    matched = keyed.join(written_table(known, "attempt-times"), TIME)
    own = matched.where(M.subject_side(subject, F.col("at_home"), "HOMEDESCRIPTION",
                                       "VISITORDESCRIPTION"))
    return written_table(own.select("GAME_ID", TIME, MARGIN), "margins")


def merge_margins(attempts: DataFrame, margins: DataFrame) -> DataFrame:
    """Attempts, each with its margin; without one where the log has none."""
    return M.attach(with_attempt_time(attempts.drop(MARGIN)), margins, TIME, MARGIN)


def reconcile(attempts: DataFrame, margins: DataFrame) -> DataFrame:
    """Games whose number of attempts differs from the number of margins found."""
    games = attempts.select(F.concat(F.lit("00"), F.col("game_id").cast("string")).alias("GAME_ID"))
    return M.differing_counts(games, margins, "GAME_ID")
