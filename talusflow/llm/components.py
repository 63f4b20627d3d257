"""Connected components by alternating star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talusflow.llm.common import written


def _minima(rows: DataFrame) -> DataFrame:
    return written(rows.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "component-minima")


def _edges(rows: DataFrame) -> DataFrame:
    return written(rows.where("a > b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).select("a", "b"),
                   "component-edges")


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()


def connected(edges: DataFrame) -> DataFrame:
    """`node`, `root` (smallest node of its component) for each node that has an edge `a`, `b`.

    Large-star hangs the larger neighbours of a node on its smallest one, small-star the smaller
    ones; when nothing changes all edges lead to roots. Minima and edges are written in each step:
    the join of a node's many edges with its one minimum can then be split where a node is hot.
    """
    current = _edges(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    before, state = None, _state(current)
    while state != before:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            current.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _edges(both.join(_minima(both), "u").where("v > u").select(
            F.col("v").alias("a"), F.col("m").alias("b")))
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        low = _minima(down)
        current = _edges(down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        before, state = state, _state(current)
    roots = current.select("b").distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
