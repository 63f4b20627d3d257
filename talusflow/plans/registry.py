"""Registry of the queries over the driver tables, each beside its check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talusflow.plans import proxy
from talusflow.schemas import DEPTHS, METRIC_NAMES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `check` is a SELECT that may use the views below."""

    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(run(spark, sf_dir))
        if check is not None:
            CHECKS[name] = with_views(check)
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Output types that both engines share: bigint, double, string, boolean."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(f.name))
    return df.select(*columns)


def _select(columns: list[str], source: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


def _soil_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT event_id AS weather_data_id, '{depth}' AS depth, "
        f"{proxy.SOIL_TEMPERATURE.format(i=i)} AS temperature, "
        f"{proxy.SOIL_MOISTURE.format(i=i)} AS moisture FROM events"
        for i, depth in enumerate(DEPTHS)
    )


def layer_sql(otherwise: str, aggregate: str = "max") -> str:
    """The eight columns of a soil pivot, or of its one-hot form without the aggregate."""
    return ", ".join(
        f"{aggregate}(CASE WHEN depth = '{depth}' THEN CAST({source} AS DOUBLE) {otherwise} END) "
        f"AS {prefix}_{suffix}"
        for source, prefix in (("temperature", "soil_temp"), ("moisture", "soil_moisture"))
        for depth, suffix in DEPTHS.items()
    )


METRICS_SQL = ", ".join(METRIC_NAMES)
WEATHER_SQL = ", ".join(
    f"CAST({m} AS DOUBLE) AS {m}"
    for m in ("temperature", "rain", "precipitation", "relative_humidity"))

VIEWS = {
    "location": f"SELECT DISTINCT user_id AS location_id, {proxy.LON} AS longitude, "
                f"{proxy.LAT} AS latitude FROM events",
    "datetime_dim": _select(proxy.DATETIME, "events"),
    "weather_data": _select(proxy.WEATHER, "events"),
    "soil": _soil_sql(),
    "landslide_event": _select(proxy.EVENT, f"events WHERE {proxy.IS_EVENT}"),
    "points": _select(proxy.POINTS, "events"),
    "catalogue": _select(proxy.CATALOGUE, "orders"),
    "blocks": _select(proxy.BLOCK, f"events WHERE {proxy.IS_EVENT}"),
    "block_hours": "SELECT *, "
                   + ", ".join(f"{text} AS {name}" for name, text in proxy.HOURLY.items())
                   + " FROM blocks CROSS JOIN (SELECT CAST(range AS INT) AS hour FROM range(24))",
    "soil_wide": f"SELECT weather_data_id, {layer_sql('')} FROM soil GROUP BY weather_data_id",
    "weather_soil": f"SELECT fact_id, location_id, datetime_id, {WEATHER_SQL}, "
                    "s.* EXCLUDE (weather_data_id) FROM weather_data w JOIN soil_wide s "
                    "ON w.fact_id = s.weather_data_id",
    "facts": f"SELECT fact_id, location_id, year, month, date, time, {METRICS_SQL} "
             "FROM weather_soil JOIN datetime_dim USING (datetime_id)",
    "labelled": "SELECT event_id, location_id, year, month, date, landslide_type, size, "
                "CASE WHEN landslide_type IS NULL THEN 0 ELSE 1 END AS label "
                "FROM landslide_event JOIN datetime_dim USING (datetime_id)",
    "joined": "SELECT e.*, w.fact_id, w.time, "
              + ", ".join(f"w.{m}" for m in METRIC_NAMES)
              + " FROM labelled e JOIN facts w ON e.location_id = w.location_id "
                "AND e.date = w.date AND e.month = w.month AND e.year = w.year",
    "deduped": "SELECT * FROM joined QUALIFY row_number() OVER "
               "(PARTITION BY location_id, time, event_id ORDER BY fact_id) = 1",
    "gridded": "SELECT e.event_id, e.label, g.hour, "
               + ", ".join(f"coalesce(d.{m}, 0.0) AS {m}" for m in METRIC_NAMES)
               + " FROM (SELECT DISTINCT event_id, label FROM deduped) e "
                 "CROSS JOIN (SELECT CAST(range AS BIGINT) AS hour FROM range(24)) g "
                 "LEFT JOIN deduped d ON d.event_id = e.event_id AND d.time = g.hour",
    "point_hours": "SELECT point_id, hour(ts) AS hour, "
                   "min_by(event_id, ts) AS event_id FROM points GROUP BY point_id, hour(ts)",
}


def with_views(body: str) -> str:
    """The statement with the views it uses, and those they use, as common table expressions."""
    needed: set[str] = set()
    open_texts = [body]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        for name in VIEWS.keys() & words - needed:
            needed.add(name)
            open_texts.append(VIEWS[name])
    if not needed:
        return body
    ctes = ", ".join(f"{name} AS ({text})" for name, text in VIEWS.items() if name in needed)
    return f"WITH {ctes} {body}"
