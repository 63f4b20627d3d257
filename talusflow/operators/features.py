"""From the star schema to one row of hourly sequences per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talusflow.functions.scalars import hour_of
from talusflow.functions.vectors import sequence_name
from talusflow.operators.indexing import first_per_key
from talusflow.operators.skew import skew_join
from talusflow.schemas import DAY_KEYS, DEPTHS, HOURS, METRIC_NAMES, METRICS

WEATHER_METRICS = ["temperature", "rain", "precipitation", "relative_humidity"]


def _layer_columns(floor_zero: bool) -> dict[str, Column]:
    columns = {}
    for source, prefix in (("temperature", "soil_temp"), ("moisture", "soil_moisture")):
        for depth, suffix in DEPTHS.items():
            value = F.when(F.col("depth") == depth, F.col(source).cast("double"))
            columns[f"{prefix}_{suffix}"] = value.otherwise(0.0) if floor_zero else value
    return columns


def onehot_depth(soil: DataFrame) -> DataFrame:
    """One column per (measure, layer): the value in its own layer's column, 0 in the others."""
    columns = _layer_columns(floor_zero=True)
    return soil.select("weather_data_id", "depth",
                       *[value.alias(name) for name, value in columns.items()])


def pivot_soil(soil: DataFrame, floor_zero: bool = False) -> DataFrame:
    """One row per fact with a column per (measure, layer), as partial and final maxima.

    A layer without a row is NULL. With `floor_zero` it is 0, and the zeros that the other layers'
    rows put into a column also replace its values below 0.
    """
    columns = _layer_columns(floor_zero)
    return soil.groupBy("weather_data_id").agg(
        *[F.max(value).alias(name) for name, value in columns.items()]
    )


def join_weather_soil(weather: DataFrame, soil_wide: DataFrame) -> DataFrame:
    """Weather facts with their soil layers; both sides are unique on the fact."""
    values = [F.col(m).cast("double").alias(m) for m in WEATHER_METRICS]
    return weather.select("fact_id", "location_id", "datetime_id", *values).join(
        soil_wide.withColumnRenamed("weather_data_id", "fact_id"), "fact_id"
    )


def join_datetime(df: DataFrame, times: DataFrame, with_time: bool = True) -> DataFrame:
    """Add the calendar columns of the row's own datetime entry."""
    columns = ["datetime_id", "year", "month", "date", *(["time"] if with_time else [])]
    return df.join(times.select(*columns), "datetime_id")


def hourly_facts(weather: DataFrame, soil: DataFrame, times: DataFrame,
                 floor_zero: bool = False) -> DataFrame:
    """Facts with calendar columns and all twelve metrics."""
    return join_datetime(join_weather_soil(weather, pivot_soil(soil, floor_zero)), times).select(
        "fact_id", *DAY_KEYS, "time", *METRIC_NAMES
    )


def label_of(landslide_type: str = "landslide_type") -> Column:
    """1 for a recorded event, 0 for a control (no type)."""
    return F.when(F.col(landslide_type).isNotNull(), 1).otherwise(0)


def label_events(events: DataFrame, times: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Events with their day and label; `keep` names further columns to carry along."""
    return join_datetime(events, times, with_time=False).select(
        "event_id", "landslide_type", "size", *DAY_KEYS, label_of().alias("label"), *keep
    )


def union_labelled(df: DataFrame) -> DataFrame:
    """Typed rows with label 1 and the others with label 0, as a union of the two halves.

    Reads its input twice; `label_of` gives the same rows in one pass.
    """
    kind = F.col("landslide_type")
    typed = df.where(kind.isNotNull()).withColumn("label", F.lit(1))
    return typed.unionByName(df.where(kind.isNull()).withColumn("label", F.lit(0)))


def facts_per_hour(facts: DataFrame) -> DataFrame:
    """The lowest fact of each location and hour, and how many facts fell into it (`n_facts`).

    Every event of a location and day sees the same hours, so this reduction before the join
    gives the rows that a dedup after it would, without pairing each event with each repeat.
    """
    kept = ["fact_id", *METRIC_NAMES]
    return facts.groupBy(*DAY_KEYS, "time").agg(
        F.min(F.struct(*kept)).alias("_first"), F.count(F.lit(1)).alias("n_facts")
    ).select(*DAY_KEYS, "time", "_first.*", "n_facts")


def join_event_weather_day(labelled: DataFrame, per_hour: DataFrame) -> DataFrame:
    """Each event with the hours of its own location and day (at most one row per hour)."""
    return skew_join(labelled, per_hour, DAY_KEYS, ["event_id"])


def dedup_event_hour(labelled: DataFrame, facts: DataFrame) -> DataFrame:
    """One row per (location, time, event): the fact with the lowest id."""
    lowest = first_per_key(facts, [*DAY_KEYS, "time"], ["fact_id"])
    return join_event_weather_day(labelled, lowest)


def dedup_location_time(labelled: DataFrame, facts: DataFrame) -> DataFrame:
    """One row per (location, time of day): lowest event, then lowest fact.

    Only the lowest event of a location and day can survive, so the others go before the join.
    """
    lowest_event = first_per_key(labelled, DAY_KEYS, ["event_id"])
    lowest_fact = first_per_key(facts, [*DAY_KEYS, "time"], ["fact_id"])
    joined = lowest_event.join(lowest_fact, DAY_KEYS)
    return first_per_key(joined, ["location_id", "time"], ["event_id", "fact_id"])


def hour_slots(hours: DataFrame, keys: list[str], metrics: list[str],
               hour: str = "hour", order: str = "fact_id",
               n_hours: int = HOURS, fill: float | str = 0.0,
               describe: Sequence[str] = ()) -> DataFrame:
    """Fixed-length arrays `features_<metric>` per key, ordered by hour, with the hours seen, `n_hours`.

    `hours` may repeat an hour: the row with the lowest `order` wins. One aggregation with a slot
    per hour does the dedup, the ordering and the grid: each task sends at most `n_hours` rows
    per key into the only shuffle, and no list is gathered. Missing values get `fill`; with
    `fill='mean'` the mean of the key's own values (0 when it has none). `describe` names columns
    that describe the key; of different descriptions of one key the lowest is taken.
    """
    values = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in metrics)
    slots = ", ".join(f"min(CASE WHEN {hour} = {h} THEN _row END)" for h in range(n_hours))
    about = [F.min(F.struct(*describe)).alias("_about")] if describe else []
    keys_and_more = [*keys, "_about.*"] if describe else keys
    days = (
        hours.selectExpr(*keys, hour, f"struct({order} AS _order, {values}) AS _row", *describe)
        .groupBy(*keys).agg(F.expr(f"array({slots})").alias("_slots"), *about)
        .selectExpr(*keys_and_more, "_slots", "size(array_compact(_slots)) AS n_hours")
    )
    keys = [*keys, *describe]
    if fill == "mean":
        known = {m: f"array_compact(_slots.{m})" for m in metrics}
        days = days.selectExpr("*", *[
            f"coalesce(try_divide(aggregate({k}, 0D, (total, v) -> total + v), size({k})), 0D) "
            f"AS _mean_{m}" for m, k in known.items()])
    default = {m: f"_mean_{m}" if fill == "mean" else f"{float(fill)!r}D" for m in metrics}
    return days.selectExpr(*keys, "n_hours", *[
        f"transform(_slots, slot -> coalesce(slot.{m}, {default[m]})) AS {sequence_name(m)}"
        for m in metrics])


def event_sequences(labelled: DataFrame, facts: DataFrame, fill: float | str = 0.0,
                    keep: Sequence[str] = ()) -> DataFrame:
    """One row per event: label, the columns in `keep`, and twelve sequences of 24 hours.

    The sequences belong to a location and day, so they are packed once and joined to the events
    of that day. Where very many events fall on one day, its one packed row is copied per salt and
    its events spread over as many tasks; the facts themselves are never copied.
    """
    timed = facts.withColumn("hour", hour_of("time", facts.schema["time"].dataType))
    events = labelled.select("event_id", "label", *keep, *DAY_KEYS)
    days = hour_slots(timed, DAY_KEYS, METRIC_NAMES, fill=fill)
    return skew_join(events, days, DAY_KEYS, ["event_id"]).drop(*DAY_KEYS)


def predict_sequences(hourly: DataFrame, fill: float | str = 0.0,
                      describe: Sequence[str] = ()) -> DataFrame:
    """The same arrays from hourly files: one row per `Index`, raw metric names."""
    named = hourly.select(
        "Index", F.hour("datetime").alias("hour"), "datetime", *describe,
        *[F.col(raw).cast("double").alias(name) for name, raw in METRICS.items()],
    )
    return hour_slots(named, ["Index"], METRIC_NAMES, order="datetime", fill=fill,
                      describe=describe)


POINT_INFO = ["longitude_info", "latitude_info", "date", "year", "month", "elevation", "time"]


def outline_metadata(hourly: DataFrame) -> DataFrame:
    """The distinct descriptions of the points to score."""
    return hourly.select("Index", *POINT_INFO).distinct()


def outline_means(hourly: DataFrame) -> DataFrame:
    """Mean of each metric per point."""
    return hourly.groupBy("Index").agg(*[F.avg(raw).alias(name) for name, raw in METRICS.items()])


def join_event_location(events: DataFrame, locations: DataFrame) -> DataFrame:
    """Coordinates of each event. Both sides are plain tables, so a hot location is split at run
    time by the skew-join rule."""
    return events.join(locations.select("location_id", "longitude", "latitude"),
                       "location_id").select("event_id", "longitude", "latitude")


def join_feature_event(features: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Features with the coordinates of their event; one `event_id` column."""
    return features.join(coordinates, "event_id")


PLACE_DAY = ["longitude", "latitude", "year", "month", "date"]


def join_point_observation(points: DataFrame, observations: DataFrame, by: list[str],
                           time: str = "time", order: Sequence[str] = ("fact_id",),
                           how: str = "inner") -> DataFrame:
    """Points with the hourly observations of their coordinates and day.

    An hour that was observed more than once counts once (lowest `order`). `by` spreads the
    points of a place and day that holds very many of them. With `how='left'` a point without an
    observation keeps one row, without values.
    """
    lowest = first_per_key(observations, [*PLACE_DAY, time], list(order))
    return skew_join(points, lowest, PLACE_DAY, by, how)
