"""The same functions by name for SQL users, as temporary SQL functions.

Spark inlines their bodies into the plan, so they cost what the expression costs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyrate.functions import scalars as S


def _distance_case() -> str:
    arms = " ".join(f"WHEN d < {t} THEN {i}" for i, t in enumerate(S.DISTANCE_THRESHOLDS))
    return f"CASE WHEN d IS NULL OR isnan(d) THEN NULL {arms} ELSE {len(S.DISTANCE_THRESHOLDS)} END"


def _action_case() -> str:
    arms = " ".join(f"WHEN contains(a, '{needle}') THEN '{label}'" for needle, label in S.ACTION_RULES)
    return f"CASE {arms} ELSE '{S.ACTION_DEFAULT}' END"


def definitions() -> dict[str, str]:
    """Function name with arguments and type -> body."""
    limit = S.MARGIN_LIMIT
    return {
        "tie_to_zero(m STRING) RETURNS DOUBLE":
            "try_cast(CASE WHEN m = 'TIE' THEN '0' ELSE m END AS DOUBLE)",
        "margin_bucket(m DOUBLE) RETURNS INT": f"try_cast(m / {S.MARGIN_WIDTH} AS INT)",
        "clamp_margin(b INT) RETURNS INT":
            f"CASE WHEN b > {limit} THEN {limit} WHEN b < -{limit} THEN -{limit} ELSE b END",
        "clamp_period(p INT) RETURNS INT":
            f"CASE WHEN p > {S.LAST_PERIOD} THEN {S.LAST_PERIOD} ELSE p END",
        "distance_bin(d DOUBLE) RETURNS INT": _distance_case(),
        "fold_x(x INT) RETURNS INT":
            f"CASE WHEN x > {S.HALF_LENGTH} THEN {S.FULL_LENGTH} - x ELSE x END",
        "fold_y(x INT, y INT) RETURNS INT":
            f"CASE WHEN x > {S.HALF_LENGTH} THEN {S.FULL_WIDTH} - y WHEN x IS NOT NULL THEN y END",
        "action_category(a STRING) RETURNS STRING": _action_case(),
        "pct2(part BIGINT, whole BIGINT) RETURNS DOUBLE":
            "floor(cast(cast(cast(part AS FLOAT) / cast(whole AS FLOAT) AS FLOAT) AS DOUBLE)"
            " * 100D + 0.5D) / 100D",
        "concat_zone(a STRING, b STRING) RETURNS STRING":
            "concat(coalesce(a, 'null'), ' ', coalesce(b, 'null'))",
    }


def register(spark: SparkSession) -> None:
    for signature, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
