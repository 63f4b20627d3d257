"""Warehouse tables by name, from parquet or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from talusflow.schemas import RULES, WAREHOUSE
from talusflow.sources.sinks import path_exists

# Session settings that describe the warehouse; credentials never stand in code.
CONF_ROOT = "spark.talusflow.warehouse."


BUCKETS = 4096  # rows of the key histogram that a partitioned read asks for


def jdbc_connection(spark: SparkSession) -> dict[str, str]:
    conf = spark.conf
    if not conf.get(CONF_ROOT + "url", None):
        raise ValueError(f"set {CONF_ROOT}url, or give the path of the tables")
    return {
        "url": conf.get(CONF_ROOT + "url"),
        "driver": conf.get(CONF_ROOT + "driver", "org.postgresql.Driver"),
        "user": conf.get(CONF_ROOT + "user"),
        "password": conf.get(CONF_ROOT + "password"),
        "fetchsize": "10000",
    }


def split_points(histogram: list[tuple[int, int]], width: int, partitions: int) -> list[int]:
    """Keys that cut a table into at most `partitions` ranges of about equal numbers of rows.

    `histogram` has (first key, rows) of each key range of `width` that holds rows. Where a range
    holds more than a partition's share it is cut evenly: keys are unique, so a full range is dense.
    """
    total = sum(rows for _, rows in histogram)
    points, due, before = [], 1, 0
    for first, rows in sorted(histogram):
        while due < partitions and before + rows >= due * total / partitions and rows:
            share = (due * total / partitions - before) / rows
            point = first + min(width, max(1, round(share * width)))
            if not points or point > points[-1]:
                points.append(point)
            due += 1
        before += rows
    return points


def range_predicates(key: str, points: list[int]) -> list[str]:
    """One condition per range between split points; together they hold for every row once."""
    if not points:
        return ["1 = 1"]
    inner = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(points, points[1:])]
    return [f"{key} < {points[0]} OR {key} IS NULL", *inner, f"{key} >= {points[-1]}"]


def _key_histogram(spark: SparkSession, table: str, key: str) -> tuple[list[tuple[int, int]], int]:
    """Rows per key range, counted in the database: at most `BUCKETS` rows come back."""
    def ask(query: str) -> DataFrame:
        return spark.read.format("jdbc").options(**jdbc_connection(spark)).option("query", query).load()

    low, high = ask(f"SELECT min({key}) AS low, max({key}) AS high FROM {table}").first()
    if low is None:
        return [], 1
    low, width = int(low), -(-(int(high) - int(low) + 1) // BUCKETS)
    counted = ask(f"SELECT bucket, count(*) AS n FROM (SELECT floor(({key} - {low}) / {width}) AS bucket "
                  f"FROM {table}) AS keys GROUP BY bucket")
    return [(low + int(r.bucket) * width, int(r.n)) for r in counted.collect() if r.bucket is not None], width


def load_table(spark: SparkSession, table: str, path: str | None = None, *,
               partitions: int = 64) -> DataFrame:
    """One warehouse table with its declared schema.

    With `path` it is read from `{path}/{table}`; otherwise over JDBC, in up to `partitions` ranges
    of the primary key that hold about equal numbers of rows, however unevenly the keys lie.
    """
    schema = WAREHOUSE[table]
    if path is not None:
        return spark.read.schema(schema).parquet(f"{path}/{table}").select(*schema.fieldNames())
    connection = jdbc_connection(spark)
    key = RULES[table].primary_key[0]
    predicates = range_predicates(key, split_points(*_key_histogram(spark, table, key), partitions))
    rows = spark.read.jdbc(connection["url"], table, predicates=predicates,
                           properties={k: v for k, v in connection.items() if k != "url"})
    return rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def finished_rows(spark: SparkSession, path: str, table: str, schema: T.StructType) -> DataFrame:
    """The rows of finished loads, with `load_id`: a load's event keys are written last."""
    load = T.StructField("load_id", T.StringType())
    done = spark.read.schema(T.StructType([load])).parquet(f"{path}/event_keys").distinct()
    rows = spark.read.schema(T.StructType([*schema.fields, load])).parquet(f"{path}/{table}")
    return rows.join(done, "load_id", "left_semi")


def load_warehouse(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All warehouse tables; what an unfinished load left behind is not read."""
    if not path_exists(spark, f"{path}/event_keys"):
        return {table: load_table(spark, table, path) for table in WAREHOUSE}
    return {table: finished_rows(spark, path, table, schema).select(*schema.fieldNames())
            for table, schema in WAREHOUSE.items()}
