"""Positions, first rows and moving frames over tables of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talusflow.operators.skew import skew_join
from talusflow.session import shared_path

_POSITION_BITS = 33  # monotonically_increasing_id keeps the in-partition position in these bits


def with_row_index(df: DataFrame, order_by: list[str], name: str = "row_index",
                   start: int = 0) -> DataFrame:
    """Dense consecutive numbers in the order of `order_by`, which should be unique.

    A range shuffle orders the table, each task numbers its own rows, and the numbered rows are
    written to the shared folder, so that a later re-run of a lost task cannot shift them. The
    offsets table has one row per written partition, which bounds both its window and its
    broadcast.
    """
    spark = df.sparkSession
    path = shared_path(spark, "row_index")
    numbered = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path).withColumn(
        "_part", F.shiftright("_id", _POSITION_BITS)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + position + F.lit(start)).alias(name)
    )


def with_number_per_key(df: DataFrame, key: str, order_by: list[str], name: str = "number",
                        start: int = 1) -> DataFrame:
    """Dense consecutive numbers within each key, in the order of `order_by`.

    The whole table is numbered along (key, order) and each key's first number is taken off, so a
    key with a third of all rows is numbered by many tasks. Rows without a key are numbered among
    themselves.
    """
    numbered = with_row_index(df, [key, *order_by], "_pos")
    first = numbered.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("_pos").alias("_first"))
    # Rows without a key are ordered first, from 0 on.
    return skew_join(numbered, first, [key], ["_pos"], "left").select(
        *df.columns, (F.col("_pos") - F.coalesce("_first", F.lit(0)) + F.lit(start)).alias(name))


def running_totals(df: DataFrame, order_by: list[str], totals: dict[str, str]) -> DataFrame:
    """Add for each `new name: column` the sum of the column over all rows before this one.

    A range shuffle orders the table, each written part is summed by its own task, and the parts'
    sums (one row per part) are carried on, so no task holds more than its part.
    """
    path = shared_path(df.sparkSession, "running")
    numbered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn(
        "_id", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    rows = df.sparkSession.read.schema(numbered.schema).parquet(path).withColumn(
        "_part", F.shiftright("_id", _POSITION_BITS))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_part").agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()]).select(
        "_part", *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in totals])
    inside = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns({
        n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in totals.items()
    }).join(F.broadcast(parts), "_part").select(
        *df.columns, *[(F.col(n) + F.col(f"_before_{n}")).alias(n) for n in totals])


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """The first row of each key. Spark keeps one row per key and task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def moving(df: DataFrame, key: str, order_by: list[str], before: int, after: int,
           measures: dict[str, Callable[[Window], Column]], block_rows: int = 100_000) -> DataFrame:
    """Aggregates over the rows from `before` to `after` around each row of its own key.

    The table is numbered along (key, order) and cut into blocks of consecutive rows. A row also
    goes to the neighbouring block when that block's frames reach it, so each block is complete
    on its own and no task holds a whole key.
    """
    if max(before, after) >= block_rows:
        raise ValueError("the frame must be shorter than a block")
    numbered = with_row_index(df, [key, *order_by], "_pos")
    home = F.floor(F.col("_pos") / block_rows)
    first = F.floor((F.col("_pos") - after) / block_rows)
    last = F.floor((F.col("_pos") + before) / block_rows)
    copied = numbered.withColumn("_home", home).withColumn("_block",
                                                           F.explode(F.sequence(first, last)))
    frame = Window.partitionBy("_block", key).orderBy("_pos").rowsBetween(-before, after)
    for name, measure in measures.items():
        copied = copied.withColumn(name, measure(frame))
    return copied.where(F.col("_block") == F.col("_home")).drop("_pos", "_home", "_block")


def positional_splits(df: DataFrame, order_by: list[str], parts: dict[str, float],
                      rest: str) -> DataFrame:
    """Cut the ordered table: each part takes its share of rows (rounded down), `rest` the others."""
    indexed = with_row_index(df, order_by, "_pos")
    total = indexed.agg(F.count(F.lit(1))).scalar()
    split = F.lit(rest)
    edge = F.lit(0).cast("long")
    edges = []
    for name, share in parts.items():
        edge = edge + F.floor(total * F.lit(share))
        edges.append((name, edge))
    for name, upper in reversed(edges):
        split = F.when(F.col("_pos") < upper, F.lit(name)).otherwise(split)
    return indexed.withColumn("split", split).drop("_pos")


def head_share(df: DataFrame, order_by: list[str], share: float) -> DataFrame:
    """The first `share` of the ordered rows (rounded down)."""
    return positional_splits(df, order_by, {"head": share}, "rest").where(
        F.col("split") == "head").drop("split")
