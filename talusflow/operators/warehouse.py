"""Loading staged hourly blocks into the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talusflow.operators.indexing import first_per_key, with_row_index
from talusflow.operators.reshape import soil_layers
from talusflow.operators.skew import skew_join
from talusflow.schemas import BLOCK_KEYS, COORD, DEPTHS, HOURS, METRIC_NAMES, WAREHOUSE

PLACE = ["longitude", "latitude"]


def _empty(spark: SparkSession, table: str) -> DataFrame:
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in WAREHOUSE[table].fields]
    return spark.range(0).select(*columns).where(F.lit(False))


def _highest(table: DataFrame, key: str) -> Column:
    return table.agg(F.coalesce(F.max(key), F.lit(0).cast("long"))).scalar()


def location_lookup(points: DataFrame, locations: DataFrame, by: list[str]) -> DataFrame:
    """Add `location_id` by exact coordinates (8 decimals); NULL when the place is unknown.

    Several entries for one place resolve to the lowest id. `by` spreads the points of a place
    that holds very many of them.
    """
    known = locations.groupBy(*PLACE).agg(F.min("location_id").alias("location_id"))
    typed = points.withColumns({c: F.col(c).cast(COORD) for c in PLACE})
    return skew_join(typed, known, PLACE, by, how="left")


def new_locations(points: DataFrame, locations: DataFrame, order_by: list[str]) -> DataFrame:
    """Places that the dimension lacks, numbered on from its highest id by first appearance."""
    attributes = ["country", "near", "continent", "elevation", *PLACE]
    typed = points.withColumns({c: F.col(c).cast(COORD) for c in PLACE})
    first = first_per_key(typed.select(*attributes, *order_by), PLACE, order_by)
    missing = first.join(locations.select(*PLACE), PLACE, "left_anti")
    numbered = with_row_index(missing, order_by, "location_id", start=1)
    return numbered.withColumn(
        "location_id", F.col("location_id") + _highest(locations, "location_id")
    ).select(*WAREHOUSE["location"].fieldNames())


def upsert_locations(points: DataFrame, locations: DataFrame, order_by: list[str]) -> DataFrame:
    """The dimension with the missing places added."""
    return locations.unionByName(new_locations(points, locations, order_by))


def first_of_block(hours: DataFrame, keys: list[str] = BLOCK_KEYS,
                   order_by: str = "datetime") -> DataFrame:
    """The first hour of each block, which stands for the block's event."""
    return first_per_key(hours, keys, [order_by])


def without_loaded(hours: DataFrame, loaded: DataFrame,
                   keys: list[str] = BLOCK_KEYS) -> DataFrame:
    """Blocks that an earlier load has not taken, so that a repeated load adds nothing."""
    return hours.join(loaded.select(*keys), keys, "left_anti")


def keyed_hours(staged: DataFrame, event_keys: DataFrame) -> DataFrame:
    """The hourly rows of the blocks with the keys of their fact: the one join of a load's hours.

    A block holds at most one fact per hour, so fact and datetime keys follow from the event key
    and the hour. Rows of the weather, datetime and soil tables are projections of this.
    """
    hour = F.hour("datetime")
    block_index = F.col("event_id") - 1
    return (
        staged.join(event_keys.drop("datetime_id"), BLOCK_KEYS)
        .withColumn("fact_id", block_index * HOURS + hour + 1)
        .withColumn("datetime_id", block_index * (HOURS + 1) + hour + 2)
        .select("fact_id", "location_id", "datetime_id", "datetime", "year", "month", "date",
                "timezone", *METRIC_NAMES)
    )


def load_star(staged: DataFrame, existing: dict[str, DataFrame] | None = None,
              store: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, DataFrame]:
    """Rows to append to each warehouse table, and `event_keys` with the keys of every block.

    Only events and new places get numbered positions. A block holds at most one fact per hour,
    so fact, datetime and soil keys follow from the event key and the hour: each event owns 25
    datetime keys (its own and one per hour), 24 fact keys and 96 soil keys. That needs no
    shuffle of the hourly rows beyond the join to their event, and gives the numbers a serial
    load of complete blocks would.

    Three tables are made of the hourly rows. `store` gets those rows with their keys and returns
    what the tables are taken from: a load that writes all tables stores them, and so joins and
    shuffles the hours once; a caller who needs one table leaves them a plan.
    """
    existing = existing or {
        name: _empty(staged.sparkSession, name) for name in ("location", "landslide_event")
    }
    first = first_of_block(staged.drop(*METRIC_NAMES))
    blocks = with_row_index(first, BLOCK_KEYS, "event_id", start=1).withColumn(
        "event_id", F.col("event_id") + _highest(existing["landslide_event"], "event_id")
    )
    added = new_locations(blocks, existing["location"], ["event_id"])
    all_places = existing["location"].unionByName(added)
    block_index = F.col("event_id") - 1
    events = location_lookup(blocks, all_places, ["event_id"]).withColumn(
        "datetime_id", block_index * (HOURS + 1) + 1
    )
    event_keys = events.select(*BLOCK_KEYS, "event_id", "location_id", "datetime_id")

    facts = store(keyed_hours(staged, event_keys))
    event_times = events.select("datetime_id", "date", "time", "timezone", "month", "year")
    fact_times = facts.select(
        "datetime_id", "date", F.date_format("datetime", "HH:mm:ss").alias("time"), "timezone",
        "month", "year",
    )
    soil = facts.select(F.col("fact_id").alias("weather_data_id"), F.inline(soil_layers())).select(
        ((F.col("weather_data_id") - 1) * len(DEPTHS) + F.col("layer") + 1).alias(
            "soil_value_id"),
        "weather_data_id", "depth", "temperature", "moisture",
    )
    return {
        "location": added,
        "datetime": event_times.unionByName(fact_times),
        "landslide_event": events.select(*WAREHOUSE["landslide_event"].fieldNames()),
        "weather_data": facts.select(*WAREHOUSE["weather_data"].fieldNames()),
        "soil": soil,
        "event_keys": event_keys,
    }


def backfill_keys(staged_events: DataFrame, event_keys: DataFrame) -> DataFrame:
    """Staging events with the keys they were given (a join instead of an update)."""
    return staged_events.join(event_keys, BLOCK_KEYS, "left")
