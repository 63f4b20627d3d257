"""Queries: files, appends and streams, each written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from talusflow.operators import features as feat
from talusflow.operators import ml
from talusflow.plans import proxy
from talusflow.plans.jobs import enrich_points, outline_scorer, training_features
from talusflow.plans.registry import VIEWS, query
from talusflow.schemas import CATALOGUE_RAW, HOURLY_FILE, POINT_RECORD, RAW_METRIC_NAMES, REGIONS, WAREHOUSE
from talusflow.session import shared_path
from talusflow.sources import files, sinks
from talusflow.sources.warehouse import load_table
from talusflow.streaming import points as stream

RECORDS = "SELECT * FROM catalogue"
POINT_PLACE = ("CAST(longitude_info AS DOUBLE) AS longitude_info, "
               "CAST(latitude_info AS DOUBLE) AS latitude_info, CAST(date AS BIGINT) AS date, "
               "CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month")


def _scan(table):
    def run(spark, sf_dir):
        path = shared_path(spark, "warehouse")
        _star(spark, sf_dir)[table].write.parquet(f"{path}/{table}")
        return load_table(spark, table, path)
    return run


def _star(spark, sf_dir):
    """The five tables with all columns of their declared schemas."""
    star = proxy.star(spark, sf_dir)
    place = {"country": "C", "near": "n", "continent": "AS"}
    star["location"] = star["location"].select(
        "*", *[F.lit(v).alias(c) for c, v in place.items()], F.col("location_id").cast("int").alias("elevation"))
    star["datetime"] = star["datetime"].withColumn("time", F.format_string("%02d:00:00", "time"))
    star["soil"] = star["soil"].withColumn("soil_value_id", F.col("weather_data_id") * 4 + F.when(
        F.col("depth") == "0 to 7 cm", 0).when(F.col("depth") == "7 to 28 cm", 1).when(
        F.col("depth") == "28 to 100 cm", 2).otherwise(3))
    return {name: df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WAREHOUSE[name].fields])
            for name, df in star.items()}


query("scan_warehouse",
      "SELECT fact_id, location_id, datetime_id, CAST(temperature AS DOUBLE) AS temperature, "
      "CAST(precipitation AS DOUBLE) AS precipitation, CAST(rain AS DOUBLE) AS rain, "
      "CAST(relative_humidity AS BIGINT) AS relative_humidity FROM weather_data")(_scan("weather_data"))
query("scan_location",
      "SELECT location_id, 'C' AS country, 'n' AS near, 'AS' AS continent, "
      "CAST(location_id AS BIGINT) AS elevation, CAST(longitude AS DOUBLE) AS longitude, "
      "CAST(latitude AS DOUBLE) AS latitude FROM location")(_scan("location"))
query("scan_datetime",
      "SELECT datetime_id, CAST(date AS BIGINT) AS date, lpad(CAST(time AS VARCHAR), 2, '0') || ':00:00' "
      "AS time, timezone, CAST(month AS BIGINT) AS month, CAST(year AS BIGINT) AS year "
      "FROM datetime_dim")(_scan("datetime"))
query("scan_soil",
      "SELECT weather_data_id * 4 + CASE depth WHEN '0 to 7 cm' THEN 0 WHEN '7 to 28 cm' THEN 1 "
      "WHEN '28 to 100 cm' THEN 2 ELSE 3 END AS soil_value_id, weather_data_id, depth, "
      "CAST(temperature AS DOUBLE) AS temperature, CAST(moisture AS DOUBLE) AS moisture FROM soil")(_scan("soil"))
query("scan_event",
      "SELECT event_id, location_id, datetime_id, hazard_type, landslide_type, size "
      "FROM landslide_event")(_scan("landslide_event"))


@query("scan_csv_typed", RECORDS)
def scan_csv_typed(spark, sf_dir):
    path = shared_path(spark, "csv")
    sinks.write_csv(proxy.catalogue(spark, sf_dir), path)
    good, _ = files.split_corrupt(files.read_csv(spark, path, CATALOGUE_RAW))
    return good


@query("scan_csv_broken",
       "SELECT 'x' || id || ',' || country || ',' || continentcode AS line FROM catalogue WHERE id % 13 = 4")
def scan_csv_broken(spark, sf_dir):
    """The lines that do not fit the declared types, as they stand in the file."""
    path = shared_path(spark, "csv")
    key = F.when(F.col("id") % 13 == 4, F.concat(F.lit("x"), "id")).otherwise(F.col("id").cast("string"))
    sinks.write_csv(proxy.catalogue(spark, sf_dir).select(key.alias("id"), "country", "continentcode"), path)
    schema = T.StructType([CATALOGUE_RAW[c] for c in ("id", "country", "continentcode")])
    _, broken = files.split_corrupt(files.read_csv(spark, path, schema))
    return broken.withColumnRenamed(files.CORRUPT, "line")


@query("scan_hourly_csv",
       f'SELECT point_id AS "Index", {POINT_PLACE}, time, CAST(elevation AS BIGINT) AS elevation, '
       f"strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime, {', '.join(RAW_METRIC_NAMES)} FROM points")
def scan_hourly_csv(spark, sf_dir):
    path = shared_path(spark, "csv")
    sinks.write_csv(proxy.points(spark, sf_dir).select(*HOURLY_FILE.fieldNames()), path)
    return files.split_corrupt(files.read_csv(spark, path, HOURLY_FILE))[0]


VIEWS["outline_days"] = (
    f"SELECT DISTINCT {proxy.LON} AS longitude, {proxy.LAT} AS latitude, year(ts) AS year, "
    "month(ts) AS month, day(ts) AS date FROM events WHERE event_type = 'purchase'")
VIEWS["outline"] = (
    "SELECT longitude, latitude, year, month, date, '00:00:00' AS time, "
    "row_number() OVER (ORDER BY longitude, latitude, year, month, date) - 1 AS point_index FROM "
    "(SELECT * FROM outline_days UNION ALL SELECT longitude, latitude, year + 1 AS year, month, date "
    "FROM outline_days)")


@query("weather_enrich",
       'SELECT o.point_index AS "Index", CAST(o.longitude AS DOUBLE) AS longitude_info, '
       "CAST(o.latitude AS DOUBLE) AS latitude_info, CAST(o.date AS BIGINT) AS date, "
       "CAST(o.year AS BIGINT) AS year, CAST(o.month AS BIGINT) AS month, o.time, "
       "CAST(p.elevation AS BIGINT) AS elevation, "
       "strftime(p.ts, '%Y-%m-%d %H:%M:%S') AS datetime, "
       f"{', '.join(RAW_METRIC_NAMES)} FROM outline o LEFT JOIN points p "
       "ON p.longitude_info = o.longitude AND p.latitude_info = o.latitude "
       "AND p.year = o.year AND p.month = o.month AND p.date = o.date")
def weather_enrich(spark, sf_dir):
    """Each place and day with a purchase, with the observations of that place and day, and the same
    places and days a year later, which nobody observed."""
    return enrich_points(_outline(spark, sf_dir), _observed(spark, sf_dir))


def _outline(spark, sf_dir):
    days = proxy.table(spark, sf_dir, "events").where("event_type = 'purchase'").selectExpr(
        f"{proxy.LON} AS longitude", f"{proxy.LAT} AS latitude", "year(ts) AS year",
        "month(ts) AS month", "day(ts) AS date", "'00:00:00' AS time").distinct()
    return days.select("*").unionByName(days.withColumn("year", F.col("year") + 1))


def _observed(spark, sf_dir):
    return proxy.points(spark, sf_dir).drop("year", "month", "date").withColumnsRenamed(
        {"longitude_info": "longitude", "latitude_info": "latitude"})


@query("scan_json_records", RECORDS)
def scan_json_records(spark, sf_dir):
    """Lines that each hold an array of records."""
    path = shared_path(spark, "json")
    record = F.struct(*CATALOGUE_RAW.fieldNames())
    lines = proxy.catalogue(spark, sf_dir).select(F.to_json(F.array(record)).alias("value"))
    lines.write.text(path)
    return files.read_json_records(spark, path, CATALOGUE_RAW)


@query("sink_csv", RECORDS)
def sink_csv(spark, sf_dir):
    """A first write and an append, by region folder."""
    path = shared_path(spark, "csv")
    rows = proxy.catalogue(spark, sf_dir)
    rows = rows.select(*[c for c in rows.columns if c != "continentcode"], "continentcode")
    north = F.col("latitude") >= 0
    sinks.write_csv(rows.where(north), path, partition_by=("continentcode",))
    sinks.write_csv(rows.where(~north), path, mode="append", partition_by=("continentcode",))
    schema = T.StructType([CATALOGUE_RAW[c] for c in rows.columns])
    return files.split_corrupt(files.read_csv(spark, path, schema))[0]


@query("sink_json", RECORDS)
def sink_json(spark, sf_dir):
    path = shared_path(spark, "json")
    sinks.write_json(proxy.catalogue(spark, sf_dir), path)
    return files.read_json_records(spark, path, CATALOGUE_RAW)


@query("sink_warehouse_append",
       "SELECT fact_id, location_id, datetime_id, CAST(temperature AS DOUBLE) AS temperature "
       "FROM weather_data")
def sink_warehouse_append(spark, sf_dir):
    """Half of the rows, then all of them: each fact is stored once."""
    path = shared_path(spark, "append")
    rows = proxy.weather_data(spark, sf_dir)
    sinks.append_new(rows.where(F.col("temperature") < 20), path, ["fact_id"])
    sinks.append_new(rows, path, ["fact_id"])
    return spark.read.schema(WAREHOUSE["weather_data"]).parquet(path).select(
        "fact_id", "location_id", "datetime_id", "temperature")


# --- Streams -----------------------------------------------------------------------------

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def _stream(spark, sf_dir):
    return stream.read_points_stream(spark, sf_dir, EVENTS, "parquet",
                                     name_filter="events.parquet")


def _finish(running) -> None:
    running.awaitTermination()


@query("stream_outline_points",
       "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts "
       "FROM events")
def stream_outline_points(spark, sf_dir):
    path = shared_path(spark, "stream")
    _finish(stream.write_files(_stream(spark, sf_dir), f"{path}/rows", f"{path}/state"))
    return spark.read.schema(EVENTS).parquet(f"{path}/rows")


@query("stream_dedup",
       "SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def stream_dedup(spark, sf_dir):
    """Every message arrives twice; each event is kept once."""
    path = shared_path(spark, "stream")
    rows = _stream(spark, sf_dir).select("event_id", "event_type",
                                         F.col("ts").cast("timestamp").alias("ts"))
    twice = rows.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    unique = stream.dedup_stream(twice, ["event_id"], "ts", spread=4).drop("delivery")
    _finish(stream.write_files(unique, f"{path}/rows", f"{path}/state"))
    return spark.read.schema("event_id long, event_type string, ts timestamp").parquet(
        f"{path}/rows")


@query("stream_count", "SELECT event_type, count(*) AS n_received FROM events GROUP BY event_type")
def stream_count(spark, sf_dir):
    path = shared_path(spark, "stream")
    counts = stream.count_stream(_stream(spark, sf_dir), "event_type")
    _finish(stream.write_snapshots(counts, f"{path}/counts", f"{path}/state"))
    return stream.latest_snapshot(spark, f"{path}/counts")


@query("stream_count_all", "SELECT count(*) AS n_received FROM events")
def stream_count_all(spark, sf_dir):
    path = shared_path(spark, "stream")
    counts = stream.count_stream(_stream(spark, sf_dir))
    _finish(stream.write_snapshots(counts, f"{path}/counts", f"{path}/state"))
    return stream.latest_snapshot(spark, f"{path}/counts")


@query("file_arrival", "SELECT 'events.parquet' AS file_name, count(*) AS n_rows FROM events")
def file_arrival(spark, sf_dir):
    path = shared_path(spark, "stream")
    _finish(stream.log_file_arrivals(_stream(spark, sf_dir), f"{path}/files", f"{path}/state"))
    return spark.read.parquet(f"{path}/files").select("file_name", "n_rows")


def _messages_sql(order: str) -> str:
    return ("SELECT topic, number, '\"' || topic || ' [' || number || ']\"' AS payload FROM "
            f"(SELECT event_type AS topic, row_number() OVER (PARTITION BY event_type ORDER BY {order}) "
            "AS number FROM events)")


@query("publish_messages", _messages_sql("event_id"))
def publish_messages(spark, sf_dir):
    return stream.numbered_messages(proxy.table(spark, sf_dir, "events"), "event_type", "event_type",
                                    ["event_id"])


@query("stream_publish", _messages_sql("event_id % 2, event_id"))
def stream_publish(spark, sf_dir):
    """Two deliveries; the numbers of a topic run on from the first to the second."""
    path = shared_path(spark, "stream")
    events = proxy.table(spark, sf_dir, "events").select(*EVENTS.fieldNames())
    for rest in (0, 1):
        events.where(F.col("event_id") % 2 == rest).write.mode("append").parquet(f"{path}/landing")
        arriving = stream.read_points_stream(spark, f"{path}/landing", EVENTS, "parquet")
        _finish(stream.publish_stream(arriving, "event_type", "event_type", ["event_id"], f"{path}/out",
                                      f"{path}/state"))
    return spark.read.parquet(f"{path}/out").select("topic", "number", "payload")


# Two deliveries of points: those north of the equator, then all of them. A point is scored when its
# day is over for a day, by the newest observation of any point that has arrived.
IN_A_REGION = " ".join(
    f"WHEN longitude BETWEEN {r.min_longitude} AND {r.max_longitude} AND latitude BETWEEN "
    f"{r.min_latitude} AND {r.max_latitude} THEN '{r.name}'" for r in REGIONS)


VIEWS["numbered_outline"] = (
    "SELECT *, row_number() OVER (ORDER BY latitude < 0, longitude, latitude, year, month, date) - 1 "
    'AS "Index" FROM outline')
VIEWS["outline_hours"] = (
    'SELECT "Index", count(DISTINCT hour(p.ts)) AS n_hours, max(p.ts) AS last FROM numbered_outline o '
    "LEFT JOIN points p ON p.longitude_info = o.longitude AND p.latitude_info = o.latitude "
    "AND p.year = o.year AND p.month = o.month AND p.date = o.date GROUP BY \"Index\"")


@query("stream_score",
       'SELECT "Index", CAST(longitude AS DOUBLE) AS longitude_info, '
       "CAST(latitude AS DOUBLE) AS latitude_info, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, "
       f"CAST(date AS BIGINT) AS date, n_hours, CASE {IN_A_REGION} END AS region, "
       f"n_hours > 0 AND CASE {IN_A_REGION} END IS NOT NULL AS scored "
       'FROM numbered_outline JOIN outline_hours USING ("Index") '
       "WHERE n_hours = 24 OR make_timestamp(year, month, date, 0, 0, 0) + INTERVAL 1 DAY "
       "<= (SELECT max(last) - INTERVAL 1 DAY FROM outline_hours)")
def stream_score(spark, sf_dir):
    """Points from landing files, enriched, gated, routed and scored as they arrive."""
    path = shared_path(spark, "stream")
    outline = _outline(spark, sf_dir).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in
                                               POINT_RECORD.fields if f.name != "country"])
    models = ml.train_per_region(training_features(proxy.star(spark, sf_dir)))
    score = outline_scorer(spark, _observed(spark, sf_dir), models, f"{path}/state")
    for arrived in (outline.where("latitude >= 0"), outline):
        arrived.write.mode("append").json(f"{path}/landing")
        points = stream.read_points_stream(spark, f"{path}/landing", POINT_RECORD)
        _finish(stream.score_stream(points, score, f"{path}/scores", f"{path}/offsets"))
    scores = spark.read.parquet(f"{path}/scores")
    in_range = F.col("probability").between(0, 1)
    return scores.select("Index", *feat.POINT_INFO[:2], "year", "month", "date", "n_hours", "region",
                         F.coalesce(in_range, F.lit(False)).alias("scored"))
