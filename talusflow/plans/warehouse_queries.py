"""Queries: catalogue parsing, staging, star load, audits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from talusflow.functions import scalars as sc
from talusflow.operators import catalogue as cat
from talusflow.operators import quality as qc
from talusflow.operators import warehouse as wh
from talusflow.operators.indexing import head_share, positional_splits
from talusflow.operators.reshape import explode_hourly
from talusflow.plans import proxy
from talusflow.plans.registry import METRICS_SQL, VIEWS, query
from talusflow.schemas import DEPTHS, METRIC_NAMES, RULES, TableRules

# --- Catalogue ---------------------------------------------------------------------------

DATE_SQL = "CAST(try_strptime(date, '%m/%d/%Y') AS DATE)"
VIEWS["parsed"] = (
    "SELECT * EXCLUDE (date, time, hazard_type, landslide_type, landslide_size), "
    f"{DATE_SQL} AS event_date, strftime(try_strptime(time, '%H:%M:%S'), '%H:%M:%S') AS time, "
    "nullif(hazard_type, 'nan') AS hazard_type, nullif(landslide_type, 'nan') AS landslide_type, "
    "nullif(landslide_size, 'nan') AS landslide_size FROM catalogue"
)
VIEWS["controls"] = (
    "SELECT * EXCLUDE (event_date, hazard_type, landslide_type, landslide_size), "
    "CAST(event_date - INTERVAL 1 YEAR AS DATE) AS event_date, NULL AS hazard_type, "
    "NULL AS landslide_type, NULL AS landslide_size, true AS is_control FROM parsed "
    "UNION ALL BY NAME SELECT *, false AS is_control FROM parsed"
)
DATED = ("CAST(event_date AS VARCHAR) AS event_date, year(event_date) AS year, "
         "month(event_date) AS month, day(event_date) AS date")
RECORD = ("id, country, near, continentcode, latitude, longitude, time, hazard_type, "
          "landslide_type, landslide_size")


def _parsed(spark, sf_dir):
    return cat.parse_catalogue(proxy.catalogue(spark, sf_dir))


@query("catalogue_union",
       "SELECT *, 'north' AS source FROM catalogue WHERE latitude >= 0 UNION ALL "
       "SELECT *, 'south' AS source FROM catalogue WHERE latitude < 0")
def catalogue_union(spark, sf_dir):
    records = proxy.catalogue(spark, sf_dir)
    return cat.catalogue_union(north=records.where(F.col("latitude") >= 0),
                               south=records.where(F.col("latitude") < 0))


@query("parse_date", f"SELECT id, CAST({DATE_SQL} AS VARCHAR) AS event_date FROM catalogue")
def parse_date(spark, sf_dir):
    return proxy.catalogue(spark, sf_dir).select("id", sc.parse_date("date").alias("event_date"))


@query("parse_time", "SELECT id, strftime(try_strptime(time, '%H:%M:%S'), '%H:%M:%S') AS time "
                     "FROM catalogue")
def parse_time(spark, sf_dir):
    return proxy.catalogue(spark, sf_dir).select("id", sc.parse_time("time").alias("time"))


@query("parse_catalogue", f"SELECT {RECORD}, {DATED} FROM parsed")
def parse_catalogue(spark, sf_dir):
    return _parsed(spark, sf_dir)


@query("outer_merge_id", f"SELECT {RECORD}, {DATED} FROM parsed")
def outer_merge_id(spark, sf_dir):
    records = _parsed(spark, sf_dir)
    return cat.outer_merge_id(
        records.select("id", *cat.DATE_COLUMNS), records.select("id", *cat.LOCATION_COLUMNS),
        records.select("id", *cat.HAZARD_COLUMNS))


@query("year_minus_one",
       "SELECT o_orderkey, CAST(CAST(o_orderdate - INTERVAL 1 YEAR AS DATE) AS VARCHAR) "
       "AS control_date FROM orders")
def year_minus_one(spark, sf_dir):
    return proxy.table(spark, sf_dir, "orders").select(
        "o_orderkey", sc.year_minus_one("o_orderdate").alias("control_date"))


@query("negative_controls", f"SELECT {RECORD}, {DATED}, is_control FROM controls "
                            "WHERE event_date IS NOT NULL")
def negative_controls(spark, sf_dir):
    dated, _ = cat.split_undated(_parsed(spark, sf_dir))
    return cat.with_negative_controls(dated)


@query("quarantine_undated", f"SELECT {RECORD}, {DATED} FROM parsed WHERE event_date IS NULL")
def quarantine_undated(spark, sf_dir):
    return cat.split_undated(_parsed(spark, sf_dir))[1]


@query("format_iso_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso_date "
                          "FROM orders")
def format_iso_date(spark, sf_dir):
    day = F.col("o_orderdate")
    return proxy.table(spark, sf_dir, "orders").select(
        "o_orderkey", sc.iso_date(F.year(day), F.month(day), F.dayofmonth(day)).alias("iso_date"))


@query("run_name", "SELECT event_id, event_type || '_' || strftime(ts, '%Y%m%d') AS run_name "
                   "FROM events")
def run_name(spark, sf_dir):
    return proxy.table(spark, sf_dir, "events").select(
        "event_id", sc.run_name("event_type", "ts").alias("run_name"))


@query("nan_to_null",
       "SELECT id, nullif(landslide_type, 'nan') AS landslide_type, "
       "nullif(landslide_size, 'nan') AS landslide_size, "
       "CASE WHEN id % 3 = 0 THEN NULL ELSE latitude END AS latitude FROM catalogue")
def nan_to_null(spark, sf_dir):
    latitude = F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("latitude"))
    records = proxy.catalogue(spark, sf_dir).withColumn("latitude", latitude)
    return records.select("id", *[
        sc.nan_to_null(c, records.schema[c].dataType).alias(c)
        for c in ("landslide_type", "landslide_size", "latitude")])


@query("round_to_schema",
       "SELECT event_id, CAST(CAST(round(CAST(value AS DECIMAL(20,6)), 0) AS SMALLINT) AS BIGINT) "
       "AS whole, CAST(CAST(CAST(value / 8 AS DECIMAL(12,5)) AS DECIMAL(5,2)) AS DOUBLE) AS cents "
       "FROM events")
def round_to_schema(spark, sf_dir):
    return proxy.table(spark, sf_dir, "events").select(
        "event_id", sc.to_schema("value", T.ShortType()).alias("whole"),
        sc.to_schema(F.expr("CAST(value / 8 AS DECIMAL(12,5))"), T.DecimalType(5, 2)).alias(
            "cents"))


@query("coords_as_string",
       "SELECT location_id, '{\"latitude\":\"' || CAST(latitude AS VARCHAR) || '\",\"longitude\":\"'"
       " || CAST(longitude AS VARCHAR) || '\"}' AS record FROM location")
def coords_as_string(spark, sf_dir):
    return proxy.location(spark, sf_dir).select(
        "location_id", F.to_json(F.struct(*[F.col(c).cast("string").alias(c)
                                            for c in ("latitude", "longitude")])).alias("record"))


@query("country_code",
       "SELECT c_custkey, coalesce(d.code, 'Unknown') AS country_code FROM "
       "(SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) "
       "LEFT JOIN (SELECT n_name, upper(substr(r_name, 1, 2)) || n_nationkey AS code FROM nation "
       "JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA') d USING (n_name)")
def country_code(spark, sf_dir):
    nation, region = (proxy.table(spark, sf_dir, n) for n in ("nation", "region"))
    customers = proxy.table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("country"))
    codes = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where(
        F.col("r_name") != "ASIA").select(
        F.col("n_name").alias("name"),
        F.expr("concat(upper(substr(r_name, 1, 2)), n_nationkey)").alias("code"))
    coded = cat.with_country_code(customers, codes)
    return coded.select("c_custkey", "country_code")


# --- Hourly series and blocks ------------------------------------------------------------

@query("hourly_axis",
       "SELECT event_id, strftime(date_trunc('day', ts) + to_hours(CAST(g.range AS INT)), "
       "'%Y-%m-%d %H:%M:%S') AS datetime FROM events CROSS JOIN range(24) g")
def hourly_axis(spark, sf_dir):
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    axis = sc.hourly_axis(day, day + F.make_dt_interval(days=F.lit(1)))
    return proxy.table(spark, sf_dir, "events").select("event_id", F.explode(axis).alias(
        "datetime"))


@query("arrays_to_rows",
       "SELECT event_id, strftime(date_trunc('day', ts) + to_hours(hour), '%Y-%m-%d %H:%M:%S') "
       f"AS datetime, {METRICS_SQL} FROM block_hours")
def arrays_to_rows(spark, sf_dir):
    return explode_hourly(proxy.block_series(spark, sf_dir), ["event_id"], METRIC_NAMES)


@query("first_of_block",
       "SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events "
       "QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts) = 1")
def first_of_block(spark, sf_dir):
    events = proxy.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return wh.first_of_block(events, ["user_id", "day"], "ts").select("user_id", "event_id", "ts")


PARTS = {"dev": 0.1, "test": 0.2}


@query("head_splits",
       "SELECT o_orderkey, CASE WHEN p < floor(n * 0.1) THEN 'dev' "
       "WHEN p < floor(n * 0.1) + floor(n * 0.2) THEN 'test' ELSE 'production' END AS split FROM "
       "(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p, "
       "count(*) OVER () AS n FROM orders)")
def head_splits(spark, sf_dir):
    orders = proxy.table(spark, sf_dir, "orders").select("o_orderkey")
    return positional_splits(orders, ["o_orderkey"], PARTS, "production")


@query("presentation_sample",
       "SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, "
       "row_number() OVER (ORDER BY o_orderkey) - 1 AS p, count(*) OVER () AS n FROM orders) "
       "WHERE p < floor(n * 0.1)")
def presentation_sample(spark, sf_dir):
    orders = proxy.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return head_share(orders, ["o_orderkey"], 0.1)


# --- Star load ---------------------------------------------------------------------------

VIEWS["staged"] = (
    "SELECT source, id, is_control, "
    "date_trunc('day', ts) + to_hours(hour) AS datetime, '12:30:00' AS time, year, month, date, "
    "hour, timezone, country, near, continent, nullif(hazard_type, 'nan') AS hazard_type, "
    "nullif(landslide_type, 'nan') AS landslide_type, size, elevation, longitude, latitude, "
    + ", ".join(
        f"CAST(round({m}, 0) AS SMALLINT) AS {m}" if m == "relative_humidity"
        else f"CAST({m} AS DECIMAL(6,3)) AS {m}" if m.startswith("soil_moisture")
        else f"CAST({m} AS DECIMAL(5,2)) AS {m}" for m in METRIC_NAMES)
    + " FROM block_hours"
)
VIEWS["keyed_blocks"] = (
    "SELECT *, row_number() OVER (ORDER BY source, id, is_control) AS event_id FROM staged "
    "WHERE hour = 0"
)
VIEWS["new_places"] = (
    "SELECT row_number() OVER (ORDER BY event_id) AS location_id, country, near, continent, "
    "elevation, longitude, latitude FROM (SELECT * FROM keyed_blocks QUALIFY row_number() OVER "
    "(PARTITION BY longitude, latitude ORDER BY event_id) = 1)"
)
VIEWS["loaded_events"] = (
    "SELECT b.*, p.location_id, (event_id - 1) * 25 + 1 AS datetime_id FROM keyed_blocks b "
    "JOIN new_places p USING (longitude, latitude)"
)
VIEWS["loaded_facts"] = (
    "SELECT s.*, e.location_id, (e.event_id - 1) * 24 + s.hour + 1 AS fact_id, "
    "(e.event_id - 1) * 25 + s.hour + 2 AS datetime_id FROM staged s "
    "JOIN (SELECT source, id, is_control, event_id, location_id FROM loaded_events) e "
    "USING (source, id, is_control)"
)


def _star(spark, sf_dir):
    return wh.load_star(cat.stage_rows(proxy.block_hours(spark, sf_dir)))


@query("star_load_location",
       "SELECT location_id, country, near, continent, CAST(elevation AS BIGINT) AS elevation, "
       "CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude "
       "FROM new_places")
def star_load_location(spark, sf_dir):
    return _star(spark, sf_dir)["location"]


@query("star_load_datetime",
       "SELECT datetime_id, CAST(date AS BIGINT) AS date, time, timezone, "
       "CAST(month AS BIGINT) AS month, CAST(year AS BIGINT) AS year FROM loaded_events "
       "UNION ALL SELECT datetime_id, date, strftime(datetime, '%H:%M:%S'), timezone, month, year "
       "FROM loaded_facts")
def star_load_datetime(spark, sf_dir):
    return _star(spark, sf_dir)["datetime"]


@query("star_load_event", "SELECT event_id, location_id, datetime_id, hazard_type, "
                          "landslide_type, size FROM loaded_events")
def star_load_event(spark, sf_dir):
    return _star(spark, sf_dir)["landslide_event"]


@query("star_load_weather",
       "SELECT fact_id, location_id, datetime_id, CAST(temperature AS DOUBLE) AS temperature, "
       "CAST(precipitation AS DOUBLE) AS precipitation, CAST(rain AS DOUBLE) AS rain, "
       "CAST(relative_humidity AS BIGINT) AS relative_humidity FROM loaded_facts")
def star_load_weather(spark, sf_dir):
    return _star(spark, sf_dir)["weather_data"]


@query("star_load_soil", " UNION ALL ".join(
    f"SELECT (fact_id - 1) * 4 + {i + 1} AS soil_value_id, fact_id AS weather_data_id, "
    f"'{depth}' AS depth, CAST(soil_temp_{s} AS DOUBLE) AS temperature, "
    f"CAST(soil_moisture_{s} AS DOUBLE) AS moisture FROM loaded_facts"
    for i, (depth, s) in enumerate(DEPTHS.items())))
def star_load_soil(spark, sf_dir):
    return _star(spark, sf_dir)["soil"]


@query("event_backfill_keys",
       "SELECT source, id, is_control, size, event_id, location_id, datetime_id "
       "FROM loaded_events")
def event_backfill_keys(spark, sf_dir):
    staged = cat.stage_rows(proxy.block_hours(spark, sf_dir))
    events = wh.first_of_block(staged).select("source", "id", "is_control", "size")
    return wh.backfill_keys(events, wh.load_star(staged)["event_keys"])


# Known places: those of users with more than three signups; points: every event's.
VIEWS["known_places"] = (
    f"SELECT user_id AS location_id, {proxy.LON} AS longitude, {proxy.LAT} AS latitude "
    "FROM events WHERE event_type = 'signup' GROUP BY user_id HAVING count(*) > 3"
)


def _known(spark, sf_dir):
    signups = proxy.table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    return signups.groupBy("user_id").count().where(F.col("count") > 3).selectExpr(
        "user_id AS location_id", "CAST(NULL AS STRING) AS country",
        "CAST(NULL AS STRING) AS near", "CAST(NULL AS STRING) AS continent",
        "CAST(0 AS INT) AS elevation", f"{proxy.LON} AS longitude", f"{proxy.LAT} AS latitude")


@query("location_lookup",
       "SELECT e.event_id, k.location_id FROM (SELECT event_id, "
       f"{proxy.LON} AS longitude, {proxy.LAT} AS latitude FROM events) e LEFT JOIN "
       "(SELECT longitude, latitude, min(location_id) AS location_id FROM known_places "
       "GROUP BY ALL) k USING (longitude, latitude)")
def location_lookup(spark, sf_dir):
    points = proxy.table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{proxy.LON} AS longitude", f"{proxy.LAT} AS latitude")
    return wh.location_lookup(points, _known(spark, sf_dir), ["event_id"]).select(
        "event_id", "location_id")


@query("location_upsert",
       "SELECT location_id, CAST(longitude AS DOUBLE) AS longitude, "
       "CAST(latitude AS DOUBLE) AS latitude FROM known_places UNION ALL "
       "SELECT (SELECT max(location_id) FROM known_places) + "
       "row_number() OVER (ORDER BY first_id), longitude, latitude FROM "
       f"(SELECT {proxy.LON} AS longitude, {proxy.LAT} AS latitude, min(event_id) AS first_id "
       "FROM events GROUP BY 1, 2) p WHERE NOT EXISTS (SELECT 1 FROM known_places k "
       "WHERE k.longitude = p.longitude AND k.latitude = p.latitude)")
def location_upsert(spark, sf_dir):
    points = proxy.table(spark, sf_dir, "events").selectExpr(
        "event_id", "'C' AS country", "'n' AS near", "'AS' AS continent",
        "CAST(user_id AS INT) AS elevation", f"{proxy.LON} AS longitude",
        f"{proxy.LAT} AS latitude")
    return wh.upsert_locations(points, _known(spark, sf_dir), ["event_id"]).select(
        "location_id", "longitude", "latitude")


# --- Audits ------------------------------------------------------------------------------

# Facts as they might arrive: some humidity over 100, some missing rain, long names.
ARRIVING_COLUMNS = [
    "event_id",
    "CAST(month(ts) + CASE WHEN event_type = 'error' THEN 12 ELSE 0 END AS INT) AS month",
    "event_id % 103 AS relative_humidity",
    "CASE WHEN value > 50 THEN NULL ELSE value END AS rain", "value AS temperature",
    "CASE WHEN event_type = 'click' THEN NULL ELSE user_id END AS location_id",
    "event_type AS timezone", "CONCAT(event_type, ' ', props) AS country",
]
VIEWS["arriving"] = f"SELECT {', '.join(ARRIVING_COLUMNS)} FROM events"
ARRIVING = TableRules(
    primary_key=("event_id",), not_null=("location_id", "rain", "temperature"),
    ranges={"month": (1, 12), "relative_humidity": (0, 100)},
    max_length={"country": 15, "timezone": 6})


def _arriving(spark, sf_dir):
    return proxy.table(spark, sf_dir, "events").selectExpr(*ARRIVING_COLUMNS)


def _report_sql(rule: str, tests: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, '{rule}' AS rule, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE {test}) AS n_violations FROM arriving"
        for column, test in tests.items())


RANGE_TESTS = {"month": "month NOT BETWEEN 1 AND 12",
               "relative_humidity": "relative_humidity NOT BETWEEN 0 AND 100"}
NULL_TESTS = {c: f"{c} IS NULL" for c in ARRIVING.not_null}
LENGTH_TESTS = {c: f"length({c}) > {n}" for c, n in ARRIVING.max_length.items()}


@query("check_ranges", _report_sql("range", RANGE_TESTS))
def check_ranges(spark, sf_dir):
    return qc.check_ranges(_arriving(spark, sf_dir), ARRIVING)


@query("check_not_null", _report_sql("not_null", NULL_TESTS))
def check_not_null(spark, sf_dir):
    return qc.check_not_null(_arriving(spark, sf_dir), ARRIVING)


@query("check_varchar_length", _report_sql("length", LENGTH_TESTS))
def check_varchar_length(spark, sf_dir):
    return qc.check_varchar_length(_arriving(spark, sf_dir), ARRIVING)


ANY_BROKEN = " OR ".join(f"coalesce({t}, false)" for t in
                         [*RANGE_TESTS.values(), *NULL_TESTS.values(), *LENGTH_TESTS.values()])


@query("quarantine_good", f"SELECT event_id, rain FROM arriving WHERE NOT ({ANY_BROKEN})")
def quarantine_good(spark, sf_dir):
    good, _ = qc.split_quarantine(_arriving(spark, sf_dir), ARRIVING)
    return good.select("event_id", "rain")


@query("quarantine_bad",
       "SELECT event_id, concat_ws(',', "
       + ", ".join(f"CASE WHEN {test} THEN '{column}:{rule}' END"
                   for rule, tests in (("range", RANGE_TESTS), ("not_null", NULL_TESTS),
                                       ("length", LENGTH_TESTS))
                   for column, test in tests.items())
       + f") AS violations FROM arriving WHERE {ANY_BROKEN}")
def quarantine_bad(spark, sf_dir):
    _, bad = qc.split_quarantine(_arriving(spark, sf_dir), ARRIVING)
    return bad.select("event_id", F.array_join("violations", ",").alias("violations"))


@query("check_primary_key",
       "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_rows "
       "FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def check_primary_key(spark, sf_dir):
    return qc.check_primary_key(proxy.table(spark, sf_dir, "lineitem"),
                                ["l_orderkey", "l_linenumber"])


@query("check_foreign_key",
       "SELECT doc_id AS key, count(*) AS n_rows FROM documents "
       "WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY ALL")
def check_foreign_key(spark, sf_dir):
    return qc.check_foreign_key(proxy.table(spark, sf_dir, "documents"), "doc_id",
                                proxy.table(spark, sf_dir, "labels"), "doc_id")


@query("check_foreign_key_report",
       "SELECT count(*) AS n_orphans, coalesce(CAST(sum(n_rows) AS BIGINT), 0) AS n_rows FROM "
       "(SELECT l_orderkey, count(*) AS n_rows FROM lineitem WHERE l_orderkey NOT IN "
       "(SELECT o_orderkey FROM orders) GROUP BY ALL)")
def check_foreign_key_report(spark, sf_dir):
    orphans = qc.check_foreign_key(proxy.table(spark, sf_dir, "lineitem"), "l_orderkey",
                                   proxy.table(spark, sf_dir, "orders"), "o_orderkey")
    return orphans.agg(F.count(F.lit(1)).alias("n_orphans"),
                       F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))


# A load that sends a tenth of the stored facts again, repeats some of its own, lacks some of its
# places and times, and has humidity beyond 100 and a missing temperature here and there.
LOAD = {
    "weather_data": (
        "event_id % 10 < 7", "event_id % 10 >= 6",
        ["event_id AS fact_id", "user_id AS location_id", "event_id AS datetime_id",
         "CAST(CASE WHEN event_id % 40 = 7 THEN NULL ELSE value END AS DECIMAL(5,2)) AS temperature",
         "CAST(event_id % 50 AS DECIMAL(5,2)) AS precipitation", "CAST(event_id % 40 AS DECIMAL(5,2)) AS rain",
         "CAST(event_id % 103 AS SMALLINT) AS relative_humidity"]),
    "datetime": (
        "event_id % 10 < 7", "event_id % 10 >= 7 AND event_id % 200 <> 9",
        ["event_id AS datetime_id", "CAST(day(ts) AS SMALLINT) AS date",
         "CASE WHEN hour(ts) < 10 THEN CONCAT('0', CAST(hour(ts) AS VARCHAR(2)), ':00:00') "
         "ELSE CONCAT(CAST(hour(ts) AS VARCHAR(2)), ':00:00') END AS time",
         "event_type AS timezone", "CAST(month(ts) + event_id % 13 AS SMALLINT) AS month",
         "CAST(year(ts) AS INT) AS year"]),
}
TWICE = "event_id % 100 = 8"
VIEWS["load_weather"] = (
    f"SELECT {', '.join(LOAD['weather_data'][2])} FROM events WHERE {LOAD['weather_data'][1]} UNION ALL "
    f"SELECT {', '.join(LOAD['weather_data'][2])} FROM events WHERE {TWICE}")
VIEWS["load_datetime"] = f"SELECT {', '.join(LOAD['datetime'][2])} FROM events WHERE {LOAD['datetime'][1]}"
VIEWS["load_places"] = (
    f"SELECT DISTINCT user_id AS location_id, {proxy.LON} AS longitude, {proxy.LAT} AS latitude FROM events "
    "WHERE user_id % 11 <> 5")
VIEWS["known_facts"] = f"SELECT event_id AS fact_id FROM events WHERE {LOAD['weather_data'][0]}"
VIEWS["known_times"] = f"SELECT event_id AS datetime_id FROM events WHERE {LOAD['datetime'][0]}"


def _line_sql(table: str, column: str, rule: str, test: str, source: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, count(*) AS n_rows, "
            f"count(*) FILTER (WHERE {test}) AS n_violations FROM {source}")


def _audit_sql() -> str:
    found = []
    for table, source in (("location", "load_places"), ("datetime", "load_datetime"), ("weather_data", "load_weather")):
        rules = RULES[table]
        found += [_line_sql(table, c, "range", f"{c} NOT BETWEEN {low} AND {high}", source)
                  for c, (low, high) in rules.ranges.items()]
        null = {c: "elevation" if c == "elevation" else c for c in rules.not_null}
        found += [_line_sql(table, c, "not_null", "true" if table == "location" and c == "elevation"
                            else f"{null[c]} IS NULL", source) for c in rules.not_null]
        found += [_line_sql(table, c, "length", "false" if table == "location" else f"length({c}) > {n}", source)
                  for c, n in rules.max_length.items()]
        key = rules.primary_key[0]
        found.append(_line_sql(table, key, "primary_key",
                               f"{key} IN (SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)", source))
    found.append(_line_sql("weather_data", "fact_id", "taken_key", "fact_id IN (SELECT fact_id FROM known_facts)",
                           "load_weather"))
    found.append(_line_sql("datetime", "datetime_id", "taken_key",
                           "datetime_id IN (SELECT datetime_id FROM known_times)", "load_datetime"))
    found.append(_line_sql("weather_data", "location_id", "foreign_key",
                           "location_id NOT IN (SELECT location_id FROM load_places)", "load_weather"))
    found.append(_line_sql("weather_data", "datetime_id", "foreign_key",
                           "datetime_id NOT IN (SELECT datetime_id FROM load_datetime UNION "
                           "SELECT datetime_id FROM known_times)", "load_weather"))
    return " UNION ALL ".join(found)


@query("load_audit", _audit_sql())
def load_audit(spark, sf_dir):
    events = proxy.table(spark, sf_dir, "events")
    tables = {name: (events.where(known).selectExpr(*columns), events.where(sent).selectExpr(*columns))
              for name, (known, sent, columns) in LOAD.items()}
    repeated = events.where(TWICE).selectExpr(*LOAD["weather_data"][2])
    places = proxy.location(spark, sf_dir).where("location_id % 11 <> 5").selectExpr(
        "location_id", "'C' AS country", "'n' AS near", "'AS' AS continent", "CAST(NULL AS INT) AS elevation",
        "longitude", "latitude")
    new = {"location": places, "datetime": tables["datetime"][1],
           "weather_data": tables["weather_data"][1].unionByName(repeated)}
    before = {name: known for name, (known, _) in tables.items()}
    return qc.load_audit(new, before, RULES)
