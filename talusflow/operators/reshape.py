"""Wide to long, arrays to rows, rows per hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talusflow.functions.scalars import hourly_axis
from talusflow.schemas import DEPTHS, HOURS


def soil_layers() -> Column:
    """The four soil layers of a wide row as an array of (layer, depth, temperature, moisture)."""
    return F.array(*[
        F.struct(
            F.lit(i).alias("layer"), F.lit(depth).alias("depth"),
            F.col(f"soil_temp_{suffix}").alias("temperature"),
            F.col(f"soil_moisture_{suffix}").alias("moisture"),
        )
        for i, (depth, suffix) in enumerate(DEPTHS.items())
    ])


def unpivot_soil(wide: DataFrame, keys: list[str]) -> DataFrame:
    """Eight wide columns to four rows per key, in one pass."""
    return wide.select(*keys, F.inline(soil_layers()))


def explode_hourly(series: DataFrame, keys: list[str], metrics: list[str],
                   start: str = "start", end: str = "end",
                   interval_seconds: int = 3600) -> DataFrame:
    """Parallel arrays with a time axis to one row per time."""
    axis = hourly_axis(F.col(start), F.col(end), interval_seconds)
    zipped = F.arrays_zip(axis.alias("datetime"), *[F.col(m) for m in metrics])
    return series.select(*keys, F.inline(zipped)).toDF(*keys, "datetime", *metrics)


def replicate_hours(df: DataFrame, hours: int = HOURS) -> DataFrame:
    """One row per hour of the day for each input row, keyed by `hour`."""
    return df.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(hours - 1))))
