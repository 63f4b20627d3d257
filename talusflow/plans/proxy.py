"""The star schema and its input files, derived from the driver tables.

Select lists are portable SQL, so that the same text defines a view here and in the check SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talusflow.schemas import DEPTHS, METRICS

LON = "CAST(((user_id * 37) % 360) - 180 AS DECIMAL(11,8))"
LAT = "CAST(((user_id * 17) % 180) - 90 AS DECIMAL(11,8))"
IS_EVENT = "event_type IN ('error', 'purchase')"
SOIL_TEMPERATURE = "CAST(value - ({i} * 20 + 10) AS DECIMAL(5,2))"
SOIL_MOISTURE = "CAST((event_id + {i}) % 100 AS DECIMAL(6,3))"

DATETIME = [
    "event_id AS datetime_id", "CAST(day(ts) AS INT) AS date", "CAST(hour(ts) AS INT) AS time",
    "CAST(month(ts) AS INT) AS month", "CAST(year(ts) AS INT) AS year", "'UTC' AS timezone",
]
WEATHER = [
    "event_id AS fact_id", "user_id AS location_id", "event_id AS datetime_id",
    "CAST(value AS DECIMAL(5,2)) AS temperature",
    "CAST(event_id % 50 AS DECIMAL(5,2)) AS precipitation",
    "CAST(event_id % 40 AS DECIMAL(5,2)) AS rain",
    "CAST(event_id % 101 AS SMALLINT) AS relative_humidity",
]
EVENT = [
    "event_id", "user_id AS location_id", "event_id AS datetime_id",
    "CAST(NULL AS VARCHAR(50)) AS hazard_type",
    "CASE WHEN event_type = 'error' THEN 'debris flow' END AS landslide_type",
    "event_type AS size",
]

# Hourly file rows of points: one scan, raw metric names.
POINT_METRICS = [
    "value AS temperature_2m",
    "CAST(event_id % 40 AS DOUBLE) AS rain",
    "CAST(event_id % 50 AS DOUBLE) AS precipitation",
    "CAST(event_id % 101 AS DOUBLE) AS relative_humidity_2m",
    *[f"CAST({SOIL_TEMPERATURE.format(i=i)} AS DOUBLE) AS soil_temperature_{s}cm"
      for i, s in enumerate(DEPTHS.values())],
    *[f"CAST((event_id + {i}) % 100 AS DOUBLE) AS soil_moisture_{s}cm"
      for i, s in enumerate(DEPTHS.values())],
]
POINTS = [
    "user_id * 10000 + month(ts) * 100 + day(ts) AS point_id", "event_id", "ts",
    f"{LON} AS longitude_info", f"{LAT} AS latitude_info",
    "CAST(day(ts) AS INT) AS date", "CAST(year(ts) AS INT) AS year",
    "CAST(month(ts) AS INT) AS month", "CAST(user_id * 3 AS INT) AS elevation",
    "'12:00:00' AS time", *POINT_METRICS,
]

# Catalogue text as it arrives: some dates and times are no dates and times.
CATALOGUE = [
    "o_orderkey AS id",
    "CASE WHEN o_orderkey % 7 = 3 THEN '13/45/2020' ELSE CONCAT(CAST(month(o_orderdate) AS "
    "VARCHAR(2)), '/', CAST(day(o_orderdate) AS VARCHAR(2)), '/', CAST(year(o_orderdate) AS "
    "VARCHAR(4))) END AS date",
    "CASE WHEN o_orderkey % 11 = 5 THEN 'xx' ELSE CONCAT(CAST(o_orderkey % 24 AS VARCHAR(2)), "
    "':', lpad(CAST(o_orderkey % 60 AS VARCHAR(2)), 2, '0'), ':', "
    "lpad(CAST((o_orderkey * 7) % 60 AS VARCHAR(2)), 2, '0')) END AS time",
    "CONCAT('NATION_', CAST(o_custkey % 25 AS VARCHAR(2))) AS country",
    "o_orderpriority AS near",
    "CASE o_orderkey % 4 WHEN 0 THEN 'NA' WHEN 1 THEN 'AS' WHEN 2 THEN 'SA' ELSE 'EU' END "
    "AS continentcode",
    "'landslide' AS hazard_type",
    "CASE WHEN o_orderstatus = 'P' THEN 'nan' ELSE o_orderstatus END AS landslide_type",
    "CASE WHEN o_orderkey % 3 = 0 THEN 'nan' ELSE 'medium' END AS landslide_size",
    "CAST((o_custkey * 17) % 18000 - 9000 AS DOUBLE) / 100 AS latitude",
    "CAST((o_custkey * 37) % 36000 - 18000 AS DOUBLE) / 100 AS longitude",
]


def _hourly_formula(position: int, name: str) -> str:
    base = f"(event_id * {position + 3} + hour * {7 * position + 11})"
    if name == "relative_humidity":
        return f"CAST({base} % 101 AS DOUBLE)"
    if name.startswith("soil_moisture"):
        return f"CAST({base} % 1000 AS DOUBLE) / 1000"
    if name in ("rain", "precipitation"):
        return f"CAST({base} % 500 AS DOUBLE) / 100"
    return f"CAST({base} % 4000 - 1000 AS DOUBLE) / 100"


HOURLY = {name: _hourly_formula(i, name) for i, name in enumerate(METRICS)}

BLOCK = [
    "event_type AS source", "event_id AS id", "event_type <> 'error' AS is_control", "event_id",
    "ts", "'UTC' AS timezone", "CAST(year(ts) AS INT) AS year",
    "CAST(month(ts) AS SMALLINT) AS month", "CAST(day(ts) AS SMALLINT) AS date",
    "CONCAT('C', CAST(user_id AS VARCHAR(10))) AS country",
    "CONCAT('near ', CAST(user_id AS VARCHAR(10))) AS near", "'AS' AS continent",
    "CASE WHEN event_type = 'error' THEN 'landslide' ELSE 'nan' END AS hazard_type",
    "CASE WHEN event_type = 'error' THEN 'debris flow' ELSE 'nan' END AS landslide_type",
    "event_type AS size", "CAST(user_id * 3 AS INT) AS elevation",
    f"{LON} AS longitude", f"{LAT} AS latitude",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id").distinct().selectExpr(
        "user_id AS location_id", f"{LON} AS longitude", f"{LAT} AS latitude")


def datetime_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*DATETIME)


def weather_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*WEATHER)


def soil(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = F.array(*[
        F.struct(F.lit(depth).alias("depth"),
                 F.expr(SOIL_TEMPERATURE.format(i=i)).alias("temperature"),
                 F.expr(SOIL_MOISTURE.format(i=i)).alias("moisture"))
        for i, depth in enumerate(DEPTHS)
    ])
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("weather_data_id"), F.inline(layers))


def landslide_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(IS_EVENT).selectExpr(*EVENT)


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five warehouse tables."""
    return {
        "location": location(spark, sf_dir), "datetime": datetime_dim(spark, sf_dir),
        "weather_data": weather_data(spark, sf_dir), "soil": soil(spark, sf_dir),
        "landslide_event": landslide_event(spark, sf_dir),
    }


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly file rows of the points to score."""
    rows = table(spark, sf_dir, "events").selectExpr(*POINTS)
    return rows.withColumn("datetime", F.col("ts").cast("timestamp")).withColumnRenamed(
        "point_id", "Index")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*CATALOGUE)


BLOCK_ROWS = 1 << 15  # blocks of one task: less than a million hours to sort


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event block, before its hours; spread out, since each row grows 24-fold.

    The blocks are counted: partitions left to adaptive execution are merged by the bytes they have
    before they grow, and a task then holds 24 times as much, more the larger the table is.
    """
    rows = table(spark, sf_dir, "events").where(IS_EVENT).selectExpr(*BLOCK)
    parts = max(spark.sparkContext.defaultParallelism, 1 + rows.count() // BLOCK_ROWS)
    return rows.repartition(parts, "id")


def block_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 hourly rows per event block, untyped as a file would hold them."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    hours = blocks(spark, sf_dir).withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return hours.withColumns({
        **{name: F.expr(text) for name, text in HOURLY.items()},
        "datetime": F.timestamp_seconds(F.unix_seconds(day) + F.col("hour") * 3600),
        "time": F.lit("12:30:00"),
    }).drop("event_id", "ts")


def block_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same metrics as parallel arrays per event, with the start and end of their axis."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    rows = blocks(spark, sf_dir).withColumns({"start": day, "end": day + F.make_dt_interval(
        days=F.lit(1))})
    arrays = {
        name: F.expr(f"transform(sequence(0, 23), hour -> {text})")
        for name, text in HOURLY.items()
    }
    return rows.select("event_id", "start", "end", *[a.alias(n) for n, a in arrays.items()])
