"""Declared schemas, domain constants and table rules. Nothing in the package infers a schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- Fixed values: names, domains, boxes, table schemas and rules that results depend on ---

# Soil layers, as stored in the `depth` column, and the suffix each one gets as a column.
DEPTHS = {
    "0 to 7 cm": "0_to_7",
    "7 to 28 cm": "7_to_28",
    "28 to 100 cm": "28_to_100",
    "100 to 255 cm": "100_to_255",
}

# The twelve hourly metrics in feature-vector order: warehouse name -> name in hourly files.
METRICS = {
    "temperature": "temperature_2m",
    "rain": "rain",
    "precipitation": "precipitation",
    "relative_humidity": "relative_humidity_2m",
    "soil_temp_0_to_7": "soil_temperature_0_to_7cm",
    "soil_temp_7_to_28": "soil_temperature_7_to_28cm",
    "soil_temp_28_to_100": "soil_temperature_28_to_100cm",
    "soil_temp_100_to_255": "soil_temperature_100_to_255cm",
    "soil_moisture_0_to_7": "soil_moisture_0_to_7cm",
    "soil_moisture_7_to_28": "soil_moisture_7_to_28cm",
    "soil_moisture_28_to_100": "soil_moisture_28_to_100cm",
    "soil_moisture_100_to_255": "soil_moisture_100_to_255cm",
}

HOURS = 24

# Country spellings that a country list does not hold, and what to say for the rest.
COUNTRY_ALIASES = {
    "Democratic Republic of Congo": "COD",
    "Myanmar (Burma)": "MMR",
    "North Korea": "PRK",
    "South Korea": "KOR",
    "The Republic of Korea": "KOR",
    "St. Lucia": "LCA",
}
UNKNOWN_COUNTRY = "Unknown"

DATE_PATTERN = "M/d/yyyy"
TIME_PATTERN = "H:m:s"

# Classifier settings.
LOGREG_PARAMS = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8}
TEXT_LOGREG_PARAMS = {"maxIter": 10, "regParam": 0.001}
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 42


@dataclass(frozen=True)
class Region:
    """A lon/lat box with the name of the model that serves it."""

    name: str
    min_longitude: float
    max_longitude: float
    min_latitude: float
    max_latitude: float


# One table for training and for scoring, so that a model is never applied to the other box.
REGIONS = (
    Region("asia_pacific", 70, 160, -13, 25),
    Region("america", -145, -36, -55, 63),
)

METRIC_NAMES = list(METRICS)
RAW_METRIC_NAMES = list(METRICS.values())
DAY_KEYS = ["location_id", "year", "month", "date"]

COORD = T.DecimalType(11, 8)
VALUE = T.DecimalType(5, 2)
MOISTURE = T.DecimalType(6, 3)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


WAREHOUSE = {
    "location": _struct(
        location_id=T.LongType(), country=T.StringType(), near=T.StringType(),
        continent=T.StringType(), elevation=T.IntegerType(), longitude=COORD, latitude=COORD,
    ),
    "datetime": _struct(
        datetime_id=T.LongType(), date=T.ShortType(), time=T.StringType(),
        timezone=T.StringType(), month=T.ShortType(), year=T.IntegerType(),
    ),
    "weather_data": _struct(
        fact_id=T.LongType(), location_id=T.LongType(), datetime_id=T.LongType(),
        temperature=VALUE, precipitation=VALUE, rain=VALUE, relative_humidity=T.ShortType(),
    ),
    "soil": _struct(
        soil_value_id=T.LongType(), weather_data_id=T.LongType(), depth=T.StringType(),
        temperature=VALUE, moisture=MOISTURE,
    ),
    "landslide_event": _struct(
        event_id=T.LongType(), location_id=T.LongType(), datetime_id=T.LongType(),
        hazard_type=T.StringType(), landslide_type=T.StringType(), size=T.StringType(),
    ),
}

CATALOGUE_RAW = _struct(
    id=T.LongType(), date=T.StringType(), time=T.StringType(), country=T.StringType(),
    near=T.StringType(), continentcode=T.StringType(), hazard_type=T.StringType(),
    landslide_type=T.StringType(), landslide_size=T.StringType(),
    latitude=T.DoubleType(), longitude=T.DoubleType(),
)

# Points to score as they arrive, and the hourly file that enrichment makes of them.
POINT_RECORD = _struct(
    latitude=T.DoubleType(), longitude=T.DoubleType(), year=T.IntegerType(),
    month=T.IntegerType(), date=T.IntegerType(), country=T.StringType(), time=T.StringType(),
)
HOURLY_FILE = T.StructType([
    *_struct(
        Index=T.LongType(), longitude_info=T.DoubleType(), latitude_info=T.DoubleType(),
        date=T.IntegerType(), year=T.IntegerType(), month=T.IntegerType(), time=T.StringType(),
        datetime=T.TimestampType(), elevation=T.IntegerType(),
    ).fields,
    *[T.StructField(raw, T.DoubleType(), True) for raw in METRICS.values()],
])

# Hourly staging rows: one block of 24 per catalogue record, every column typed on entry.
STAGED_HOUR = T.StructType(
    [
        *_struct(
            source=T.StringType(), id=T.LongType(), is_control=T.BooleanType(),
            datetime=T.TimestampType(), time=T.StringType(), year=T.IntegerType(),
            month=T.ShortType(), date=T.ShortType(), timezone=T.StringType(),
            country=T.StringType(), near=T.StringType(), continent=T.StringType(),
            hazard_type=T.StringType(), landslide_type=T.StringType(), size=T.StringType(),
            elevation=T.IntegerType(), longitude=COORD, latitude=COORD,
        ).fields,
        *[
            T.StructField(
                name,
                T.ShortType() if name == "relative_humidity"
                else MOISTURE if name.startswith("soil_moisture") else VALUE,
                True,
            )
            for name in METRICS
        ],
    ]
)
BLOCK_KEYS = ["source", "id", "is_control"]

# The log of loaded blocks and the keys they were given.
EVENT_KEYS = _struct(
    source=T.StringType(), id=T.LongType(), is_control=T.BooleanType(), event_id=T.LongType(),
    location_id=T.LongType(), datetime_id=T.LongType(),
)


@dataclass(frozen=True)
class TableRules:
    """Constraints of one table: what the audit operators check."""

    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)


# The constraints of the star schema.
RULES = {
    "location": TableRules(
        primary_key=("location_id",),
        not_null=("elevation", "longitude", "latitude"),
        max_length={"country": 12, "near": 100, "continent": 4},
    ),
    "datetime": TableRules(
        primary_key=("datetime_id",),
        not_null=("date", "timezone", "month", "year"),
        ranges={"month": (1, 12)},
        max_length={"timezone": 15},
    ),
    "weather_data": TableRules(
        primary_key=("fact_id",),
        not_null=("location_id", "datetime_id", "temperature", "precipitation", "rain",
                  "relative_humidity"),
        ranges={"relative_humidity": (0, 100)},
        foreign_keys={"location_id": ("location", "location_id"),
                      "datetime_id": ("datetime", "datetime_id")},
    ),
    "soil": TableRules(
        primary_key=("soil_value_id",),
        not_null=("depth", "temperature", "moisture"),
        max_length={"depth": 15},
        foreign_keys={"weather_data_id": ("weather_data", "fact_id")},
    ),
    "landslide_event": TableRules(
        primary_key=("event_id",),
        not_null=("event_id", "location_id", "datetime_id"),
        max_length={"hazard_type": 50, "landslide_type": 50, "size": 20},
        foreign_keys={"location_id": ("location", "location_id"),
                      "datetime_id": ("datetime", "datetime_id")},
    ),
    "staged_hour": TableRules(
        primary_key=("source", "id", "is_control", "datetime"),
        not_null=("source", "id", "is_control", "datetime", "elevation", "longitude", "latitude",
                  "date", "timezone", "month", "year", *METRICS),
        ranges={"month": (1, 12), "relative_humidity": (0, 100)},
        max_length={"country": 12, "near": 100, "continent": 4, "timezone": 15,
                    "hazard_type": 50, "landslide_type": 50, "size": 20},
    ),
}
