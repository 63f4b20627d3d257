"""Queries: soil, joins, dedup, sequences, regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from talusflow.functions.vectors import feature_array, sequence_name, vectorise
from talusflow.operators import features as feat
from talusflow.operators import regions as reg
from talusflow.operators.ml import join_scores
from talusflow.operators.reshape import replicate_hours, unpivot_soil
from talusflow.plans import proxy
from talusflow.plans.registry import METRICS_SQL, layer_sql, query
from talusflow.schemas import DEPTHS, HOURS, METRIC_NAMES, METRICS, REGIONS

LAYER_NAMES = [f"{p}_{s}" for p in ("soil_temp", "soil_moisture") for s in DEPTHS.values()]
LAYERS = ", ".join(LAYER_NAMES)
EVENT_COLUMNS = ["event_id", "location_id", "year", "month", "date", "landslide_type", "size",
                 "label"]


def _labelled(spark, sf_dir):
    return feat.label_events(proxy.landslide_event(spark, sf_dir),
                             proxy.datetime_dim(spark, sf_dir))


def _facts(spark, sf_dir):
    return feat.hourly_facts(proxy.weather_data(spark, sf_dir), proxy.soil(spark, sf_dir),
                             proxy.datetime_dim(spark, sf_dir))


def _sequences(spark, sf_dir):
    return feat.event_sequences(_labelled(spark, sf_dir), _facts(spark, sf_dir))


def as_hours(df, keys, metrics=METRIC_NAMES):
    """Sequences back to one row per hour."""
    zipped = F.arrays_zip(F.sequence(F.lit(0), F.lit(HOURS - 1)),
                          *[F.col(sequence_name(m)) for m in metrics])
    return df.select(*keys, F.inline(zipped)).toDF(*keys, "hour", *metrics)


def thousandths(values):
    """An array of numbers as text of whole thousandths, which has one form in every engine."""
    return F.array_join(F.transform(values, lambda v: F.round(v * 1000).cast("bigint").cast(
        "string")), ",")


@query("onehot_depth",
       f"SELECT weather_data_id, depth, {layer_sql('ELSE 0', aggregate='')} FROM soil")
def onehot_depth(spark, sf_dir):
    return feat.onehot_depth(proxy.soil(spark, sf_dir))


@query("soil_pivot_max",
       f"SELECT weather_data_id, {layer_sql('ELSE 0')} FROM soil GROUP BY weather_data_id")
def soil_pivot_max(spark, sf_dir):
    return feat.pivot_soil(proxy.soil(spark, sf_dir), floor_zero=True)


@query("soil_pivot", "SELECT * FROM soil_wide")
def soil_pivot(spark, sf_dir):
    return feat.pivot_soil(proxy.soil(spark, sf_dir))


@query("soil_unpivot",
       " UNION ALL ".join(
           f"SELECT weather_data_id, CAST({i} AS BIGINT) AS layer, '{depth}' AS depth, "
           f"soil_temp_{s} AS temperature, soil_moisture_{s} AS moisture FROM soil_wide"
           for i, (depth, s) in enumerate(DEPTHS.items())))
def soil_unpivot(spark, sf_dir):
    return unpivot_soil(feat.pivot_soil(proxy.soil(spark, sf_dir)), ["weather_data_id"])


@query("join_weather_soil", "SELECT * FROM weather_soil")
def join_weather_soil(spark, sf_dir):
    return feat.join_weather_soil(proxy.weather_data(spark, sf_dir),
                                  feat.pivot_soil(proxy.soil(spark, sf_dir)))


@query("join_datetime",
       "SELECT event_id, location_id, datetime_id, CAST(year AS BIGINT) AS year, "
       "CAST(month AS BIGINT) AS month, CAST(date AS BIGINT) AS date, "
       "CAST(time AS BIGINT) AS time, landslide_type, size "
       "FROM landslide_event JOIN datetime_dim USING (datetime_id)")
def join_datetime(spark, sf_dir):
    return feat.join_datetime(proxy.landslide_event(spark, sf_dir).drop("hazard_type"),
                              proxy.datetime_dim(spark, sf_dir))


@query("join_event_weather_day",
       "SELECT event_id, location_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, "
       "CAST(date AS BIGINT) AS date, landslide_type, size, CAST(label AS BIGINT) AS label, "
       "CAST(time AS BIGINT) AS time, min(fact_id) AS fact_id, count(*) AS n_facts "
       "FROM joined GROUP BY ALL")
def join_event_weather_day(spark, sf_dir):
    joined = feat.join_event_weather_day(_labelled(spark, sf_dir),
                                         feat.facts_per_hour(_facts(spark, sf_dir)))
    return joined.select(*EVENT_COLUMNS, "time", "fact_id", "n_facts")


@query("label_literal", "SELECT event_id, landslide_type, CAST(label AS BIGINT) AS label "
                        "FROM labelled")
def label_literal(spark, sf_dir):
    return _labelled(spark, sf_dir).select("event_id", "landslide_type", "label")


@query("union_labelled", "SELECT event_id, landslide_type, size, CAST(label AS BIGINT) AS label "
                         "FROM labelled")
def union_labelled(spark, sf_dir):
    return feat.union_labelled(_labelled(spark, sf_dir).select("event_id", "landslide_type",
                                                               "size"))


@query("dedup_event_hour",
       "SELECT event_id, location_id, landslide_type, size, CAST(label AS BIGINT) AS label, "
       f"fact_id, CAST(time AS BIGINT) AS time, {METRICS_SQL} FROM deduped")
def dedup_event_hour(spark, sf_dir):
    kept = feat.dedup_event_hour(_labelled(spark, sf_dir), _facts(spark, sf_dir))
    return kept.drop("year", "month", "date")


@query("dedup_location_time",
       "SELECT event_id, location_id, landslide_type, size, CAST(label AS BIGINT) AS label, "
       f"fact_id, CAST(time AS BIGINT) AS time, {METRICS_SQL} FROM joined QUALIFY row_number() OVER "
       "(PARTITION BY location_id, time ORDER BY event_id, fact_id) = 1")
def dedup_location_time(spark, sf_dir):
    kept = feat.dedup_location_time(_labelled(spark, sf_dir), _facts(spark, sf_dir))
    return kept.drop("year", "month", "date")


@query("event_sequences", f"SELECT event_id, CAST(label AS BIGINT) AS label, hour, {METRICS_SQL} "
                          "FROM gridded")
def event_sequences(spark, sf_dir):
    return as_hours(_sequences(spark, sf_dir), ["event_id", "label"])


@query("event_label",
       "SELECT event_id, CAST(max(label) AS BIGINT) AS label, count(*) AS n_hours, "
       + ", ".join(f"CAST(sum(CAST({m} AS DECIMAL(18,3))) AS DOUBLE) AS {m}" for m in METRIC_NAMES)
       + " FROM deduped GROUP BY event_id")
def event_label(spark, sf_dir):
    sequences = _sequences(spark, sf_dir)
    totals = [
        f"round(aggregate({sequence_name(m)}, 0D, (total, v) -> total + v), 3) AS {m}"
        for m in METRIC_NAMES
    ]
    return sequences.selectExpr("event_id", "label", "n_hours", *totals)


VECTOR_SQL = " UNION ALL ".join(
    f"SELECT event_id, label, {24 * i} + hour AS position, {m} AS v FROM gridded"
    for i, m in enumerate(METRIC_NAMES))


@query("assemble_features",
       "SELECT event_id, CAST(label AS BIGINT) AS label, "
       "string_agg(CAST(CAST(round(v * 1000) AS BIGINT) AS VARCHAR), ',' ORDER BY position) "
       f"AS features, count(*) AS n_features FROM ({VECTOR_SQL}) GROUP BY event_id, label")
def assembled(spark, sf_dir):
    values = _sequences(spark, sf_dir).select("event_id", "label", feature_array().alias("v"))
    return values.select("event_id", "label", thousandths(F.col("v")).alias("features"),
                         F.size("v").alias("n_features"))


@query("array_to_vector",
       "SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n_values, "
       "array_to_string([CAST(CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR) "
       "FOR x IN embedding], ',') AS v FROM embeddings")
def array_to_vector(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    vectors = vectorise(proxy.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v")), ["v"])
    values = vector_to_array("v")
    return vectors.select("vec_id", F.size(values).alias("n_values"),
                          F.array_join(F.transform(values, lambda x: F.round(x * 1000000).cast(
                              "bigint").cast("string")), ",").alias("v"))


RAW_AS_METRICS = ", ".join(f"p.{raw} AS {m}" for m, raw in METRICS.items())
FILLED = ", ".join(f"coalesce(x.{m}, 0.0) AS {m}" for m in METRIC_NAMES)


@query("predict_sequences",
       f'SELECT k.point_id AS "Index", g.hour, {FILLED} FROM '
       "(SELECT DISTINCT point_id FROM points) k "
       "CROSS JOIN (SELECT CAST(range AS BIGINT) AS hour FROM range(24)) g "
       f"LEFT JOIN (SELECT h.point_id, h.hour, {RAW_AS_METRICS} FROM point_hours h "
       "JOIN points p USING (event_id)) x ON x.point_id = k.point_id AND x.hour = g.hour")
def predict_sequences(spark, sf_dir):
    return as_hours(feat.predict_sequences(proxy.points(spark, sf_dir)), ["Index"])


POINT_INFO = ('point_id AS "Index", CAST(longitude_info AS DOUBLE) AS longitude_info, '
              "CAST(latitude_info AS DOUBLE) AS latitude_info, CAST(date AS BIGINT) AS date, "
              "CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, "
              "CAST(elevation AS BIGINT) AS elevation, time")


@query("outline_metadata", f"SELECT DISTINCT {POINT_INFO} FROM points")
def outline_metadata(spark, sf_dir):
    return feat.outline_metadata(proxy.points(spark, sf_dir))


@query("outline_means",
       'SELECT point_id AS "Index", '
       + ", ".join(f"round(avg({raw}), 6) AS {m}" for m, raw in METRICS.items())
       + " FROM points GROUP BY point_id")
def outline_means(spark, sf_dir):
    means = feat.outline_means(proxy.points(spark, sf_dir))
    return means.select("Index", *[F.round(m, 6).alias(m) for m in METRIC_NAMES])


PLACED = ("SELECT event_id, CAST(longitude AS DOUBLE) AS longitude, "
          "CAST(latitude AS DOUBLE) AS latitude FROM landslide_event JOIN location "
          "USING (location_id)")


def _placed(spark, sf_dir):
    return feat.join_event_location(proxy.landslide_event(spark, sf_dir),
                                    proxy.location(spark, sf_dir))


@query("join_event_location", PLACED)
def join_event_location(spark, sf_dir):
    return _placed(spark, sf_dir)


@query("join_feature_event",
       f"SELECT event_id, CAST(label AS BIGINT) AS label, longitude, latitude FROM ({PLACED}) "
       "JOIN (SELECT DISTINCT event_id, label FROM deduped) USING (event_id)")
def join_feature_event(spark, sf_dir):
    joined = feat.join_feature_event(_sequences(spark, sf_dir), _placed(spark, sf_dir))
    return joined.select("event_id", "label", "longitude", "latitude")


def _box_sql(region, below, columns="*", source="location"):
    return (f"SELECT {columns} FROM {source} WHERE longitude {below[0]} {region.min_longitude} "
            f"AND longitude {below[1]} {region.max_longitude} "
            f"AND latitude {below[0]} {region.min_latitude} "
            f"AND latitude {below[1]} {region.max_latitude}")


OPEN, CLOSED = (">", "<"), (">=", "<=")
ASIA = REGIONS[0]


@query("region_filter_open", _box_sql(ASIA, OPEN, source=f"({PLACED})"))
def region_filter_open(spark, sf_dir):
    return reg.filter_region(_placed(spark, sf_dir), ASIA, inclusive=False)


@query("region_filter_closed", _box_sql(ASIA, CLOSED, source=f"({PLACED})"))
def region_filter_closed(spark, sf_dir):
    return reg.filter_region(_placed(spark, sf_dir), ASIA)


@query("region_route",
       "SELECT event_id, r.region, CAST(e.longitude AS DOUBLE) AS longitude, "
       "CAST(e.latitude AS DOUBLE) AS latitude FROM "
       f"({PLACED}) e LEFT JOIN (VALUES "
       + ", ".join(f"('{r.name}', {r.min_longitude}, {r.max_longitude}, {r.min_latitude}, "
                   f"{r.max_latitude})" for r in REGIONS)
       + ") r(region, x0, x1, y0, y1) ON e.longitude BETWEEN x0 AND x1 "
         "AND e.latitude BETWEEN y0 AND y1")
def region_route(spark, sf_dir):
    return reg.assign_region(_placed(spark, sf_dir), keep_unmatched=True)


@query("occurrence_grid",
       "SELECT CASE "
       + " ".join(f"WHEN longitude BETWEEN {r.min_longitude} AND {r.max_longitude} AND latitude BETWEEN "
                  f"{r.min_latitude} AND {r.max_latitude} THEN '{r.name}'" for r in REGIONS)
       + " END AS region, CAST(floor(CAST(longitude AS DOUBLE) / 10) AS BIGINT) AS cell_x, "
       "CAST(floor(CAST(latitude AS DOUBLE) / 10) AS BIGINT) AS cell_y, count(*) AS n_points "
       f"FROM ({PLACED}) GROUP BY ALL")
def occurrence_grid(spark, sf_dir):
    return reg.occurrence_grid(_placed(spark, sf_dir))


PLACE_SQL = "CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude"


def _observations(spark, sf_dir):
    return _facts(spark, sf_dir).join(proxy.location(spark, sf_dir), "location_id").drop(
        "location_id")


@query("join_point_observation",
       f"SELECT event_id, {PLACE_SQL}, CAST(label AS BIGINT) AS label, "
       f"CAST(time AS BIGINT) AS time, fact_id, {METRICS_SQL} "
       "FROM deduped JOIN location USING (location_id)")
def join_point_observation(spark, sf_dir):
    events = _labelled(spark, sf_dir).join(proxy.location(spark, sf_dir), "location_id").select(
        "event_id", "label", *feat.PLACE_DAY)
    joined = feat.join_point_observation(events, _observations(spark, sf_dir), ["event_id"])
    return joined.drop("year", "month", "date")


@query("replicate_zip24",
       "SELECT event_id, CAST(g.range AS BIGINT) AS hour, size FROM landslide_event "
       "CROSS JOIN range(24) g")
def replicate_zip24(spark, sf_dir):
    return replicate_hours(proxy.landslide_event(spark, sf_dir)).select("event_id", "hour",
                                                                        "size")


@query("score_outer_join",
       f"SELECT s.*, m.* EXCLUDE (\"Index\"), coalesce(s.id, m.\"Index\") AS \"Index\" FROM "
       "(SELECT user_id * 10000 + month(ts) * 100 + day(ts) AS id, "
       "max(value) AS prediction FROM events WHERE event_type = 'view' GROUP BY 1) s "
       f"FULL JOIN (SELECT DISTINCT {POINT_INFO} FROM points WHERE temperature_2m > 20) m "
       "ON s.id = m.\"Index\"".replace("s.*, m.* EXCLUDE", "s.* EXCLUDE (id), m.* EXCLUDE"))
def score_outer_join(spark, sf_dir):
    events = proxy.table(spark, sf_dir, "events")
    scores = events.where(F.col("event_type") == "view").groupBy(
        F.expr("user_id * 10000 + month(ts) * 100 + day(ts)").alias("Index")
    ).agg(F.max("value").alias("prediction"))
    metadata = feat.outline_metadata(
        proxy.points(spark, sf_dir).where(F.col("temperature_2m") > 20))
    return join_scores(scores, metadata)
