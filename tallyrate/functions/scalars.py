"""Cleaning, binning, folding and text functions on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide which cell an attempt falls into.
MARGIN_WIDTH = 5
MARGIN_LIMIT = 3
LAST_PERIOD = 5
DISTANCE_THRESHOLDS = (1, 3, 5, 7, 10, 15)
HALF_LENGTH = 47
FULL_LENGTH = 94
FULL_WIDTH = 50
HALF_WIDTH = 25
ACTION_RULES = (
    ("Tip", "Tip Shot"),
    ("Layup", "Layup Shot"),
    ("Jump", "Jump Shot"),
    ("Bank", "Bank Shot"),
    ("Dunk", "Dunk Shot"),
    ("Hook", "Hook Shot"),
    ("Fadeaway", "Fadeaway Shot"),
)
ACTION_DEFAULT = "Else"


def tie_to_zero(margin: Column) -> Column:
    """Score margin text as a double; text that is no number becomes null."""
    return F.when(margin == "TIE", F.lit("0")).otherwise(margin).try_cast("double")


def margin_bucket(margin: Column, width: int = MARGIN_WIDTH) -> Column:
    """Truncates toward zero, so bucket 0 covers both sides of a tie."""
    return (margin / width).try_cast("int")


def clamp(value: Column, low: int, high: int) -> Column:
    """Null stays null (greatest/least would skip it)."""
    return F.when(value > high, F.lit(high)).when(value < low, F.lit(low)).otherwise(value)


def clamp_margin(bucket: Column, limit: int = MARGIN_LIMIT) -> Column:
    return clamp(bucket, -limit, limit)


def margin_category(margin: Column) -> Column:
    """Margin text to its clamped bucket."""
    return clamp_margin(margin_bucket(tie_to_zero(margin)))


def clamp_period(period: Column, last: int = LAST_PERIOD) -> Column:
    return F.when(period > last, F.lit(last)).otherwise(period)


def distance_bin(distance: Column, thresholds: Sequence[float] = DISTANCE_THRESHOLDS) -> Column:
    """Index of the first threshold above the distance; null and NaN give null."""
    bins = F.when(distance.isNull() | F.isnan(distance), F.lit(None).cast("int"))
    for index, threshold in enumerate(thresholds):
        bins = bins.when(distance < threshold, F.lit(index))
    return bins.otherwise(F.lit(len(thresholds)))


def fold_x(x: Column) -> Column:
    """Mirror the far half onto the near half, along the length."""
    return F.when(x > HALF_LENGTH, F.lit(FULL_LENGTH) - x).otherwise(x)


def fold_y(x: Column, y: Column) -> Column:
    """Mirror across the width when the location lies in the far half."""
    return F.when(x > HALF_LENGTH, F.lit(FULL_WIDTH) - y).when(x.isNotNull(), y)


def scale_x(x: Column) -> Column:
    return x / F.lit(float(HALF_LENGTH))


def scale_y(y: Column) -> Column:
    return (y - F.lit(HALF_WIDTH)) / F.lit(float(HALF_WIDTH))


def scale_margin(category: Column) -> Column:
    return category / F.lit(float(MARGIN_LIMIT))


def first_match(text: Column, rules: Sequence[tuple[str, str]] = ACTION_RULES,
                default: str = ACTION_DEFAULT) -> Column:
    """Label of the first rule whose needle the text contains."""
    label = F.lit(default)
    for needle, name in reversed(rules):
        label = F.when(text.contains(needle), F.lit(name)).otherwise(label)
    return label


def concat_zone(first: Column, second: Column) -> Column:
    """Joined with a space; a missing part reads "null"."""
    missing = F.lit("null")
    return F.concat(F.coalesce(first, missing), F.lit(" "), F.coalesce(second, missing))


def indicator(value: Column, wanted: str) -> Column:
    return F.when(value == wanted, F.lit(1)).otherwise(F.lit(0))


def pct2(part: Column, whole: Column) -> Column:
    """Single-precision ratio rounded half up to two decimals."""
    ratio = (part.cast("float") / whole.cast("float")).cast("float").cast("double")
    return F.floor(ratio * F.lit(100.0) + F.lit(0.5)).cast("double") / F.lit(100.0)


def percent_text(rate: Column) -> Column:
    return F.format_string("%.1f%%", rate * 100)


def vector_element(vector: Column, index: int, digits: int = 2) -> Column:
    return F.round(vector_to_array(vector)[index], digits)


def contains_or_false(text: Column, needle: Column | str) -> Column:
    return F.coalesce(text.contains(needle), F.lit(False))


def matches_or_false(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(pattern), F.lit(False))


def not_in_or_null(value: Column, excluded: Sequence) -> Column:
    """Exclusion that keeps rows whose value is missing."""
    return F.coalesce(~value.isin(*excluded), F.lit(True))


def pad2(number: Column) -> Column:
    """Two digits at least; longer numbers stay whole."""
    text = number.cast("string")
    return F.when(number.between(0, 9), F.concat(F.lit("0"), text)).otherwise(text)


def attempt_time_key(game: Column, period: Column, minutes: Column, seconds: Column,
                     prefix: str = "00") -> Column:
    """`<prefix><game>:<period>:<minutes>:<seconds>`; null if any part is."""
    return _colon_joined(F.concat(F.lit(prefix), game.cast("string")), period, minutes, pad2(seconds))


def log_time_key(game: Column, period: Column, clock: Column) -> Column:
    """`<game>:<period>:<clock>`; null if any part is."""
    return _colon_joined(game, period, clock)


def _colon_joined(*parts: Column) -> Column:
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(":"), part.cast("string")]
    return F.concat(*pieces[1:])


def url_for_key(key: Column, head: str, tail: str = "", prefix: str = "") -> Column:
    return F.concat(F.lit(head + prefix), key.cast("string"), F.lit(tail))
