"""Joins to a side that holds few rows per key, when the other side may have hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "_salt"
PARTS = 512
FLOOR = 100_000


def hot_keys(counts: DataFrame, keys: list[str], rows: str,
             parts: int = PARTS, floor: int = FLOOR) -> DataFrame | None:
    """Keys that hold more than a 1/`parts` share of all rows, with their number of salts.

    `counts` has one row per key and is measured here, before the join is planned. Fewer than
    `parts` keys can hold more than that share, and their salts add up to at most 2 * `parts`:
    that bounds what is fetched and broadcast, whatever the data size. A key with up to `floor`
    rows is never split. None means that no key needs it and a plain join will do.
    """
    total, highest = counts.agg(F.sum(rows), F.max(rows)).first()
    quota = max(float(floor), (total or 0) / parts)
    if highest is None or highest <= quota:
        return None
    found = counts.where(F.col(rows) > quota).select(
        *keys, F.ceil(F.col(rows) / F.lit(quota)).cast("int").alias("_salts"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in found.schema.fields])
    return counts.sparkSession.createDataFrame(found.collect(), schema)


def count_hot_keys(df: DataFrame, keys: list[str],
                   parts: int = PARTS, floor: int = FLOOR) -> DataFrame | None:
    """`hot_keys` of a table that still has to be counted: one pass over its key columns."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return hot_keys(counts, keys, "_rows", parts, floor)


def spread(df: DataFrame, hot: DataFrame, keys: list[str], by: list[str | Column]) -> DataFrame:
    """Give each row of a hot key one of the key's salts, chosen by a hash of `by`.

    Rows without a key match nothing, so an outer join may put them anywhere.
    """
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    number = F.xxhash64(*by)
    salt = F.coalesce(F.pmod(number, F.col("_salts")),
                      F.when(no_key, F.pmod(number, F.lit(PARTS))), F.lit(0))
    return df.join(F.broadcast(hot), keys, "left").withColumn(SALT, salt.cast("int")).drop(
        "_salts")


def replicate(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Copy each row of a hot key once per salt; other rows stay single."""
    return (
        df.join(F.broadcast(hot), keys, "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0),
                                               F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
        .drop("_salts")
    )


def salted_join(many: DataFrame, few: DataFrame, keys: list[str], by: list[str | Column],
                hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """Join on `keys` with the hot keys of `many` spread over several tasks by a hash of `by`."""
    if hot is None:
        return many.join(few, keys, how)
    left = spread(many, hot, keys, by)
    right = replicate(few, hot, keys)
    return left.join(right, [*keys, SALT], how).drop(SALT)


def skew_join(many: DataFrame, few: DataFrame, keys: list[str], by: list[str | Column],
              how: str = "inner") -> DataFrame:
    """`salted_join` after counting the keys of `many`."""
    return salted_join(many, few, keys, by, count_hot_keys(many, keys), how)
