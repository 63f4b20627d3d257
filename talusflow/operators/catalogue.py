"""Event catalogues: parsing, negative controls, country codes, typed staging rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talusflow.functions.scalars import (
    nan_to_null,
    parse_date,
    parse_time,
    to_schema,
    year_minus_one,
)
from talusflow.schemas import COUNTRY_ALIASES, STAGED_HOUR, UNKNOWN_COUNTRY

HAZARD_COLUMNS = ["hazard_type", "landslide_type", "landslide_size"]
LOCATION_COLUMNS = ["country", "near", "continentcode", "latitude", "longitude"]
DATE_COLUMNS = ["event_date", "year", "month", "date", "time"]


def catalogue_union(**catalogues: DataFrame) -> DataFrame:
    """Catalogues with the same columns in one table, tagged with their source name."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in catalogues.items()]
    result = tagged[0]
    for df in tagged[1:]:
        result = result.unionByName(df)
    return result


def parse_catalogue(raw: DataFrame) -> DataFrame:
    """Typed catalogue records; text that is no date or time becomes NULL."""
    others = [c for c in raw.columns if c not in {"date", "time", *HAZARD_COLUMNS}]
    return raw.select(
        *others,
        parse_date("date").alias("event_date"),
        parse_time("time").alias("time"),
        *[nan_to_null(c, T.StringType()).alias(c) for c in HAZARD_COLUMNS],
    ).select(
        *others, "event_date", F.year("event_date").alias("year"),
        F.month("event_date").alias("month"), F.dayofmonth("event_date").alias("date"), "time",
        *HAZARD_COLUMNS,
    )


def split_undated(catalogue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with a date, and the quarantined ones without."""
    return (catalogue.where(F.col("event_date").isNotNull()),
            catalogue.where(F.col("event_date").isNull()))


def with_negative_controls(catalogue: DataFrame) -> DataFrame:
    """Each record and its control: the same place one year earlier without a hazard."""
    earlier = year_minus_one("event_date")
    dated = {
        "event_date": earlier, "year": F.year(earlier), "month": F.month(earlier),
        "date": F.dayofmonth(earlier),
    }
    fields = catalogue.schema.fields

    def control(f: T.StructField):
        if f.name in HAZARD_COLUMNS:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return dated.get(f.name, F.col(f.name)).alias(f.name)

    copies = F.array(
        F.struct(*[control(f) for f in fields], F.lit(True).alias("is_control")),
        F.struct(*[F.col(f.name) for f in fields], F.lit(False).alias("is_control")),
    )
    return catalogue.select(F.inline(copies))


def outer_merge_id(dates: DataFrame, locations: DataFrame, hazards: DataFrame) -> DataFrame:
    """Full outer merge of three slices of a catalogue on their unique `id`.

    All three shuffle on `id` and stay in place for both joins. A catalogue that still is one
    table has no need for it.
    """
    return dates.join(locations, "id", "full").join(hazards, "id", "full")


def with_country_code(df: DataFrame, country_dim: DataFrame,
                      aliases: Mapping[str, str] = COUNTRY_ALIASES,
                      country: str = "country") -> DataFrame:
    """Add `country_code`: by official name (of repeated ones the lowest code), else by alias, else
    'Unknown'.

    `country_dim` holds name and code. It gets no broadcast hint: the planner broadcasts it when
    its measured size allows, and otherwise shuffles with skew handling. The few aliases are
    constants of the expression.
    """
    official = country_dim.groupBy(F.col("name").alias(country)).agg(F.min("code").alias("_official"))
    alias = F.lit(None).cast("string")
    for name, code in aliases.items():
        alias = F.when(F.col(country) == name, F.lit(code)).otherwise(alias)
    return (
        df.join(official, country, "left")
        .withColumn("country_code", F.coalesce("_official", alias, F.lit(UNKNOWN_COUNTRY)))
        .drop("_official")
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `schema` with its types; 'nan' and values that do not fit become NULL."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        to_schema(nan_to_null(f.name, kinds[f.name]), f.dataType).alias(f.name)
        for f in schema.fields
    ])


def stage_rows(hourly: DataFrame) -> DataFrame:
    """Hourly rows in staging types."""
    return conform(hourly, STAGED_HOUR)
