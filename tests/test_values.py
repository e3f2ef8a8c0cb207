from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from stratafold.functions.values import cast_to, concat_key, email_for, iso_text, parse_date


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


@pytest.mark.parametrize("value, expected", [(2.5, 2), (3.5, 4), (2.7, 3), (-2.5, -2), (None, None)])
def test_float_to_whole_number_rounds_halves_to_even(spark, value, expected):
    col = F.lit(value).cast("double")
    assert one(spark, cast_to(col, T.DoubleType(), T.IntegerType())) == expected


@pytest.mark.parametrize("value, expected", [("2.5", 3), ("-2.5", -3), ("2.4", 2)])
def test_decimal_to_whole_number_rounds_halves_away_from_zero(spark, value, expected):
    col = F.lit(value).cast("decimal(10,2)")
    assert one(spark, cast_to(col, T.DecimalType(10, 2), T.LongType())) == expected


def test_bad_number_fails_or_becomes_null(spark):
    col = F.col("id").cast("string") + F.lit("")  # not folded before the job runs
    bad = F.concat(F.lit("JWG"), F.col("id").cast("string"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, cast_to(bad, T.StringType(), T.IntegerType()))
    assert one(spark, cast_to(bad, T.StringType(), T.IntegerType(), "null")) is None
    with pytest.raises(ValueError, match="on_error"):
        cast_to(col, T.StringType(), T.IntegerType(), "ignore")


def test_number_too_large_fails_or_becomes_null(spark):
    big = F.lit(3e9) + F.col("id")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        one(spark, cast_to(big, T.DoubleType(), T.IntegerType()))
    assert one(spark, cast_to(big, T.DoubleType(), T.IntegerType(), "null")) is None


def test_text_longer_than_declared_is_kept(spark):
    assert one(spark, cast_to(F.lit("x" * 30), T.StringType(), T.StringType())) == "x" * 30


def test_concat_key(spark, frame, rows):
    df = frame([(1001, 12), (10011, 2), (1001, None), (None, None)], "a bigint, b bigint")
    found = df.select("a", "b", concat_key(F.col("a"), F.col("b")).alias("k"))
    assert rows(found) == [
        (None, None, None), (1001, None, 1001), (1001, 12, 100112), (10011, 2, 100112)]
    long = frame([(123456789, 123)], "a bigint, b bigint")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CAST_OVERFLOW"):
        long.select(concat_key(F.col("a"), F.col("b"))).collect()
    assert long.select(concat_key(F.col("a"), F.col("b"), to="bigint")).first()[0] == 123456789123
    assert long.select(concat_key(F.col("a"), F.col("b"), on_error="null")).first()[0] is None


def test_date_text_round_trip(spark, frame):
    df = frame([("2024-03-31T02:30:00",), ("2024-02-29",)], "t string")
    assert [r[0] for r in df.select(parse_date(F.col("t"))).collect()] == [
        date(2024, 3, 31), date(2024, 2, 29)]
    moment = one(spark, iso_text(F.to_timestamp(F.lit("2024-01-02 03:04:05"))))
    assert moment == "2024-01-02T03:04:05"
    assert one(spark, parse_date(F.concat(F.lit("no date"), F.col("id")), "null")) is None


def test_email(spark):
    assert one(spark, email_for(F.lit("Anna de Vries"))) == "anna.de.vries@example.org"
