from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talusflow.functions import scalars as sc
from talusflow.functions.text import tokens


def values(df, column="v"):
    return [row[column] for row in df.collect()]


def texts(spark, items, name="t"):
    return spark.createDataFrame([(i,) for i in items], f"{name} string").coalesce(1)


def test_dates_accept_one_digit_and_reject_nonsense(spark):
    df = texts(spark, ["2/29/2016", "02/09/2016", "13/45/2020", "xx", None, "2/30/2016"])
    got = values(df.select(sc.parse_date("t").cast("string").alias("v")))
    assert got == ["2016-02-29", "2016-02-09", None, None, None, None]


def test_times_are_padded(spark):
    df = texts(spark, ["7:05:09", "23:59:59", "24:00:00", "noon", None])
    assert values(df.select(sc.parse_time("t").alias("v"))) == [
        "07:05:09", "23:59:59", None, None, None]


def test_leap_day_goes_to_the_28th(spark):
    df = texts(spark, ["2016-02-29", "2017-03-01"]).select(
        sc.year_minus_one(F.col("t").cast("date")).cast("string").alias("v"))
    assert values(df) == ["2015-02-28", "2016-03-01"]


def test_iso_date_pads(spark):
    df = spark.createDataFrame([(987, 3, 4)], "y int, m int, d int")
    assert values(df.select(sc.iso_date("y", "m", "d").alias("v"))) == ["0987-03-04"]


def test_hourly_axis_is_half_open_and_may_be_empty(spark):
    df = spark.range(1).select(
        F.to_timestamp(F.lit("2024-01-01")).alias("a"), F.to_timestamp(F.lit("2024-01-02")).alias("b"))
    day = df.select(sc.hourly_axis(F.col("a"), F.col("b")).alias("v")).first()["v"]
    assert len(day) == 24 and day[0] == datetime(2024, 1, 1) and day[-1] == datetime(2024, 1, 1, 23)
    assert df.select(sc.hourly_axis(F.col("a"), F.col("a")).alias("v")).first()["v"] == []
    half = df.select(sc.hourly_axis(F.col("a"), F.col("b"), 1800).alias("v")).first()["v"]
    assert len(half) == 48


def test_epoch_is_utc(spark):
    df = spark.createDataFrame([(1_700_000_000,)], "s long")
    assert values(df.select(F.date_format(sc.epoch_to_utc("s"), "yyyy-MM-dd HH:mm:ss").alias("v"))) \
        == ["2023-11-14 22:13:20"]


def test_nan_becomes_null_only_as_a_whole(spark):
    df = texts(spark, ["nan", "banana", "", None])
    assert values(df.select(sc.nan_to_null("t", T.StringType()).alias("v"))) == [
        None, "banana", "", None]
    numbers = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "x double").coalesce(1)
    assert values(numbers.select(sc.nan_to_null("x", T.DoubleType()).alias("v"))) == [
        None, 1.5, None]


@pytest.mark.parametrize("value,kind,want", [
    (87.6, T.ShortType(), 88), (-0.5, T.ShortType(), -1),
    (87.005, T.DecimalType(5, 2), Decimal("87.01")),
    (1.123456784, T.DecimalType(11, 8), Decimal("1.12345678")),
    (1.123456779, T.DecimalType(11, 8), Decimal("1.12345678")),
    (1000.0, T.DecimalType(5, 2), None), (40000.0, T.ShortType(), None),
])
def test_values_round_half_up_and_overflow_to_null(spark, value, kind, want):
    df = spark.createDataFrame([(value,)], "x double")
    assert values(df.select(sc.to_schema("x", kind).alias("v"))) == [want]


def test_hour_of_text_and_numbers(spark):
    assert values(texts(spark, ["07:30:00"]).select(
        sc.hour_of("t", T.StringType()).alias("v"))) == [7]
    assert values(spark.range(5, 6).select(sc.hour_of("id", T.LongType()).alias("v"))) == [5]


def test_names_and_messages(spark):
    df = spark.createDataFrame([("m", 3)], "t string, n int")
    assert values(df.select(sc.run_name("t", F.lit("2024-02-01").cast("date")).alias("v"))) == [
        "m_20240201"]
    assert values(df.select(sc.message("t", "n").alias("v"))) == ["m [3]"]


def test_tokens_agree_with_the_ml_tokenizer(spark):
    from pyspark.ml.feature import Tokenizer

    df = texts(spark, ["A b  C ", " lead", "tab\tand\nline", "trailing \t\n"])
    ours = values(df.select(tokens("t").alias("v")))
    theirs = values(Tokenizer(inputCol="t", outputCol="v").transform(df))
    assert ours == theirs


def test_long_ids_and_short_times_survive(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from talusflow.functions.scalars import parse_time, to_schema

    row = spark.createDataFrame([(9223372036854775807, "5:7:9", 0.4999999)], "id long, t string, x double").select(
        to_schema("id", T.LongType()).alias("id"), parse_time("t").alias("t"),
        to_schema(F.col("x"), T.IntegerType()).alias("x")).first()
    assert (row.id, row.t, row.x) == (9223372036854775807, "05:07:09", 0)
