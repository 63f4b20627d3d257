"""Region boxes and occurrence grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talusflow.schemas import REGIONS, Region


def in_box(region: Region, longitude: str = "longitude", latitude: str = "latitude",
           inclusive: bool = True) -> Column:
    """Whether a point lies in the box, with or without its edges."""
    lon, lat = F.col(longitude), F.col(latitude)
    if inclusive:
        return lon.between(region.min_longitude, region.max_longitude) & lat.between(
            region.min_latitude, region.max_latitude)
    return ((lon > region.min_longitude) & (lon < region.max_longitude)
            & (lat > region.min_latitude) & (lat < region.max_latitude))


def in_any_box(regions: Sequence[Region] = REGIONS, longitude: str = "longitude",
               latitude: str = "latitude", inclusive: bool = True) -> Column:
    """Whether a point lies in at least one of the boxes."""
    inside = F.lit(False)
    for region in regions:
        inside = inside | in_box(region, longitude, latitude, inclusive)
    return inside


def filter_region(df: DataFrame, region: Region, inclusive: bool = True,
                  longitude: str = "longitude", latitude: str = "latitude") -> DataFrame:
    """Rows inside one box."""
    return df.where(in_box(region, longitude, latitude, inclusive))


def assign_region(df: DataFrame, regions: Sequence[Region] = REGIONS, inclusive: bool = True,
                  longitude: str = "longitude", latitude: str = "latitude",
                  keep_unmatched: bool = False) -> DataFrame:
    """Add `region`; a point in two boxes comes out twice, a point in none only on demand.

    The boxes are a handful of constants, so they become an expression and need no join.
    """
    hits = F.array_compact(F.array(*[
        F.when(in_box(r, longitude, latitude, inclusive), F.lit(r.name)) for r in regions
    ]))
    explode = F.explode_outer if keep_unmatched else F.explode
    return df.withColumn("region", explode(hits))


def occurrence_grid(df: DataFrame, degrees: float = 10.0, longitude: str = "longitude",
                    latitude: str = "latitude", regions: Sequence[Region] = REGIONS) -> DataFrame:
    """Number of points per region and grid cell; points outside all regions have none (NULL)."""
    return assign_region(df, regions, True, longitude, latitude, keep_unmatched=True).groupBy(
        "region",
        F.floor(F.col(longitude).cast("double") / degrees).alias("cell_x"),
        F.floor(F.col(latitude).cast("double") / degrees).alias("cell_y"),
    ).agg(F.count(F.lit(1)).alias("n_points"))
