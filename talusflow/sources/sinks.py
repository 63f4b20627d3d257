"""Writing results: files, idempotent appends, models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talusflow.operators.indexing import first_per_key


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              partition_by: tuple[str, ...] = ()) -> None:
    """CSV files with a header; overwriting replaces only the partitions that `df` has."""
    df.write.mode(mode).option("header", True).option(
        "partitionOverwriteMode", "dynamic" if partition_by else "static"
    ).partitionBy(*partition_by).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite",
               partition_by: tuple[str, ...] = ()) -> None:
    """JSON, one record per line."""
    df.write.mode(mode).partitionBy(*partition_by).json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether something lies at the path, on whatever file system it names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _near_keys(present: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Stored keys inside the ranges of the new rows' keys (and nulls, where those have some).

    The bounds are constants, two per key, so a scan skips the files whose statistics lie outside.
    """
    bounds = rows.agg(*[f(c).alias(f"{side}_{i}") for i, c in enumerate(keys)
                        for side, f in (("low", F.min), ("high", F.max))],
                      *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(keys)]).first()
    for i, key in enumerate(keys):
        low, high = bounds[f"low_{i}"], bounds[f"high_{i}"]
        inside = F.lit(False) if low is None else F.col(key).between(F.lit(low), F.lit(high))
        present = present.where(inside | F.col(key).isNull() if bounds[f"nulls_{i}"] else inside)
    return present


def append_new(df: DataFrame, path: str, keys: list[str],
               partition_by: tuple[str, ...] = ()) -> None:
    """Append the rows whose natural key the table lacks; repeating the call adds nothing.

    Of rows with one key the lowest in its other columns is taken; null is a key like others. Only the
    stored keys inside the ranges of the new ones are read, and keys that are partition columns prune
    the folders.
    """
    spark = df.sparkSession
    rows = first_per_key(df, keys, [c for c in df.columns if c not in keys] or keys)
    if path_exists(spark, path):
        present = spark.read.schema(
            T.StructType([f for f in df.schema.fields if f.name in keys])
        ).parquet(path)
        there = _near_keys(present, rows, keys).select(*[F.col(k).alias(f"_there_{k}") for k in keys])
        rows = rows.join(there, [F.col(k).eqNullSafe(F.col(f"_there_{k}")) for k in keys], "left_anti")
    rows.select(*df.columns).write.mode("append").partitionBy(*partition_by).parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
                batch_size: int = 10_000) -> None:
    """Append over JDBC in batches."""
    df.write.mode("append").option("batchsize", batch_size).jdbc(url, table,
                                                                 properties=properties)


def model_path(root: str, region: str, run_date: str) -> str:
    """Where the model of a region and day lies."""
    return f"{root}/region={region}/run_date={run_date}"


def save_model(model: PipelineModel, root: str, region: str, run_date: str) -> str:
    """Write a fitted model and return its path."""
    path = model_path(root, region, run_date)
    model.write().overwrite().save(path)
    return path


def load_model(root: str, region: str, run_date: str) -> PipelineModel:
    return PipelineModel.load(model_path(root, region, run_date))
