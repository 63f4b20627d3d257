"""Parsing, formatting and coercion of single columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talusflow.schemas import DATE_PATTERN, TIME_PATTERN


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_time(text: str | Column) -> Column:
    """`H:M:S` text as `HH:mm:ss`; NULL when it is not a time."""
    return F.date_format(F.try_to_timestamp(_col(text), F.lit(TIME_PATTERN)), "HH:mm:ss")


def parse_date(text: str | Column) -> Column:
    """`month/day/year` text as a date; NULL when it is not one."""
    return F.try_to_timestamp(_col(text), F.lit(DATE_PATTERN)).cast("date")


def year_minus_one(date: str | Column) -> Column:
    """The same day one year earlier; 29 February becomes the 28th."""
    return F.add_months(_col(date), -12)


def iso_date(year: str | Column, month: str | Column, day: str | Column) -> Column:
    """`yyyy-MM-dd` text of three numbers."""
    return F.format_string("%04d-%02d-%02d", _col(year), _col(month), _col(day))


def hourly_axis(start: Column, end: Column, interval_seconds: int | Column = 3600) -> Column:
    """Timestamps from `start` up to but without `end`."""
    step = F.make_interval(secs=F.lit(interval_seconds) if isinstance(interval_seconds, int)
                           else interval_seconds)
    return F.when(start < end, F.sequence(start, end - step, step)).otherwise(
        F.array().cast("array<timestamp>"))


def epoch_to_utc(seconds: str | Column) -> Column:
    """Unix seconds as a timestamp (the session runs in UTC)."""
    return F.timestamp_seconds(_col(seconds))


def nan_to_null(value: str | Column, kind: T.DataType) -> Column:
    """NULL for missing-value markers: the text 'nan', or a floating NaN."""
    column = _col(value)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column)
    if isinstance(kind, T.StringType):
        return F.nullif(column, F.lit("nan"))
    return column


def to_schema(value: str | Column, kind: T.DataType) -> Column:
    """Cast the way a typed table stores it: decimals and integers round half up.

    A value that does not fit becomes NULL, so that a NOT NULL rule sends its row to quarantine.
    """
    column = _col(value)
    if isinstance(kind, (T.ShortType, T.IntegerType, T.LongType)):
        return F.round(column.try_cast("decimal(38,18)"), 0).try_cast(kind)
    return column.try_cast(kind)


def run_name(model: str | Column, date: str | Column) -> Column:
    """`{model}_{yyyyMMdd}`."""
    return F.concat_ws("_", _col(model), F.date_format(_col(date), "yyyyMMdd"))


def hour_of(time: str | Column, kind: T.DataType) -> Column:
    """Hour of day from 'HH:mm:ss' text, or from a number that already is one."""
    column = _col(time)
    if isinstance(kind, T.StringType):
        return F.substring_index(column, ":", 1).cast("int")
    return column.cast("int")


def message(text: str | Column, number: str | Column) -> Column:
    """`text [number]`, the form in which messages are published."""
    return F.format_string("%s [%d]", _col(text), _col(number))
