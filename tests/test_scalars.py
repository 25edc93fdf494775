"""Hand-computed values, edges included, for every column function."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyrate.functions import scalars as S
from tallyrate.functions import sql_surface

NAN = float("nan")


@pytest.fixture
def mapped(spark):
    """Apply a column function to rows of arguments, in order."""
    def apply(function, schema, rows):
        names = [part.split()[0] for part in schema.split(",")]
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, " + schema)
        out = df.select("i", function(*[F.col(n) for n in names]).alias("out")).orderBy("i")
        return [row.out for row in out.collect()]
    return apply


def singles(values):
    return [(value,) for value in values]


def test_tie_to_zero(mapped):
    texts = ["TIE", "7", "-4", "-18", "12.0", "x", None]
    assert mapped(S.tie_to_zero, "m string", singles(texts)) == [0, 7, -4, -18, 12, None, None]


def test_margin_bucket_truncates_toward_zero(mapped):
    values = [0.0, 4.0, -4.0, 5.0, -5.0, 9.0, -9.0, 14.9, None, NAN, 1e300]
    assert mapped(S.margin_bucket, "m double", singles(values)) == [
        0, 0, 0, 1, -1, 1, -1, 2, None, None, None]


def test_clamp_margin(mapped):
    assert mapped(S.clamp_margin, "b int", singles([-9, -4, -3, 0, 3, 4, 9, None])) == [
        -3, -3, -3, 0, 3, 3, 3, None]


def test_margin_category(mapped):
    texts = ["TIE", "-18", "-4", "12.0", "40", "x", None]
    assert mapped(S.margin_category, "m string", singles(texts)) == [0, -3, 0, 2, 3, None, None]


def test_clamp_period(mapped):
    assert mapped(S.clamp_period, "p int", singles([1, 5, 6, 7, None])) == [1, 5, 5, 5, None]


def test_distance_bin(mapped):
    values = [0.0, 0.99, 1.0, 2.99, 3.0, 5.0, 6.9, 7.0, 10.0, 14.99, 15.0, 99.0, NAN, None]
    assert mapped(S.distance_bin, "d double", singles(values)) == [
        0, 0, 1, 1, 2, 3, 3, 4, 5, 5, 6, 6, None, None]


def test_fold_court(mapped):
    assert mapped(S.fold_x, "x int", singles([0, 47, 48, 94, None])) == [0, 47, 46, 0, None]
    assert mapped(S.fold_y, "x int, y int", [(47, 10), (48, 10), (94, 50), (0, None), (None, 10)]) == [
        10, 40, 0, None, None]


def test_scaling(mapped):
    assert mapped(S.scale_x, "x double", singles([0.0, 47.0, None])) == [0, 1, None]
    assert mapped(S.scale_y, "y double", singles([0.0, 25.0, 50.0])) == [-1, 0, 1]
    assert mapped(S.scale_margin, "m int", singles([-3, 0, 3])) == [-1, 0, 1]


def test_first_match_rule_wins(mapped):
    texts = ["Jump Bank Shot", "Driving Layup Shot", "Tip Layup", "Floating Shot", "Bank Hook",
             "Turnaround Fadeaway", "Dunk", "", None]
    assert mapped(S.first_match, "a string", singles(texts)) == [
        "Jump Shot", "Layup Shot", "Tip Shot", "Else", "Bank Shot", "Fadeaway Shot", "Dunk Shot",
        "Else", "Else"]


def test_concat_zone(mapped):
    rows = [("Mid-Range", "Left Side"), (None, "Center"), ("Mid-Range", None), (None, None)]
    assert mapped(S.concat_zone, "a string, b string", rows) == [
        "Mid-Range Left Side", "null Center", "Mid-Range null", "null null"]


def test_indicator(mapped):
    assert mapped(lambda c: S.indicator(c, "O"), "t string", singles(["O", "F", None])) == [1, 0, 0]


def test_pct2_rounds_the_single_precision_ratio_half_up(mapped):
    # 1/200 lies just below 0.005 in single precision
    rows = [(0, 7), (1, 3), (2, 3), (1, 200), (1, 8), (7, 7)]
    assert mapped(S.pct2, "a bigint, b bigint", rows) == [0.0, 0.33, 0.67, 0.0, 0.13, 1.0]


def test_percent_text(mapped):
    assert mapped(S.percent_text, "p double", singles([0.532, 0.0, 1.0])) == ["53.2%", "0.0%", "100.0%"]


def test_vector_element(mapped):
    rows = [([1.236, -0.125],)]
    assert mapped(lambda v: S.vector_element(array_to_vector(v), 0), "v array<double>", rows) == [1.24]
    assert mapped(lambda v: S.vector_element(array_to_vector(v), 1), "v array<double>", rows) == [-0.13]


def test_missing_text_matches_nothing(mapped):
    texts = ["a user b", "abc", None]
    assert mapped(lambda c: S.contains_or_false(c, "user"), "t string", singles(texts)) == [
        True, False, False]
    texts = ["MISS user", "user (3 PTS)", "MISSED", "(PTS)", None]
    assert mapped(lambda c: S.matches_or_false(c, "MISS | PTS"), "t string", singles(texts)) == [
        True, True, False, False, False]


def test_missing_code_is_kept(mapped):
    assert mapped(lambda c: S.not_in_or_null(c, (10, 11, 12)), "c int", singles([10, 12, 1, None])) == [
        False, False, True, True]


def test_time_keys(mapped):
    assert mapped(S.pad2, "n int", singles([0, 5, 59, 123, None])) == ["00", "05", "59", "123", None]
    assert mapped(S.attempt_time_key, "g int, p int, m int, s int", [(21, 1, 11, 5), (21, 4, 0, 59), (21, None, 0, 0)]) == [
        "0021:1:11:05", "0021:4:0:59", None]
    assert mapped(S.log_time_key, "g string, p int, c string", [("0021", 1, "11:05"), ("0021", 1, None)]) == [
        "0021:1:11:05", None]


def test_url_for_key(mapped):
    urls = mapped(lambda c: S.url_for_key(c, "http://h/?g=", "&e=0", prefix="00"), "g int", singles([7]))
    assert urls == ["http://h/?g=007&e=0"]


def test_sql_functions_agree_with_columns(spark):
    sql_surface.register(spark)
    rows = [("TIE", 4.99, 48, 10, 6, "Tip Dunk", "a", None), ("-18", None, None, 3, 2, None, None, "b"),
            (None, NAN, 47, None, None, "x", None, None)]
    df = spark.createDataFrame(rows, "m string, d double, x int, y int, p int, a string, b string, c string")
    sql = spark.sql("""SELECT tie_to_zero(m) t, margin_bucket(tie_to_zero(m)) k,
        clamp_margin(margin_bucket(tie_to_zero(m))) c, clamp_period(p) p, distance_bin(d) d,
        fold_x(x) x, fold_y(x, y) y, action_category(a) a, concat_zone(b, c) z,
        pct2(1, 200) r FROM {df}""", df=df)
    col = F.col
    same = df.select(
        S.tie_to_zero(col("m")), S.margin_bucket(S.tie_to_zero(col("m"))), S.margin_category(col("m")),
        S.clamp_period(col("p")), S.distance_bin(col("d")), S.fold_x(col("x")),
        S.fold_y(col("x"), col("y")), S.first_match(col("a")), S.concat_zone(col("b"), col("c")),
        S.pct2(F.lit(1), F.lit(200)))
    assert [tuple(r) for r in sql.collect()] == [tuple(r) for r in same.collect()]
