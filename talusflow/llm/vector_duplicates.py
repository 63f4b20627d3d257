"""Near-duplicate vectors: Euclidean p-stable hashing in several tables, exact cosines."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talusflow.llm.common import dealt_tiles, in_runs, mixed, runs, written
from talusflow.llm.components import connected
from talusflow.llm.near_duplicates import _binary
from talusflow.llm.vectors import vector_rows

_WIDTH = 1.0  # of a quantised step, in units of the unit sphere
_SEED = 20240302


def collision(distance: float, width: float = _WIDTH) -> float:
    """Probability that a Gaussian projection puts two points at a distance into one step."""
    if distance == 0:
        return 1.0
    r = width / distance
    return erf(r / sqrt(2)) - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


def table_plan(rows: int, cosine: float, miss: float) -> tuple[int, int]:
    """Projections per table and tables.

    Projections follow the number of rows so that a bucket holds about a twentieth of an unrelated
    vector; tables follow so that a pair at the threshold is missed with probability `miss`.
    """
    near, far = collision(sqrt(2 - 2 * cosine)), collision(sqrt(2))
    projections = max(4, ceil(log(20 * max(rows, 2)) / log(1 / far)))
    return projections, ceil(log(miss) / log(1 - near**projections))


def _hashed(rows: DataFrame, projections: int, tables: int) -> DataFrame:
    """node, unit vector and table keys of the usable vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.random.default_rng(_SEED).integers(1, 2**62, projections, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                at, matrix = vector_rows(part.column("vector"))
                if not len(at):
                    continue
                scale = np.abs(matrix).max(axis=1, initial=0.0)
                at, matrix = at[scale > 0], matrix[scale > 0] / scale[scale > 0, None]
                if not len(at):
                    continue
                unit = matrix / np.sqrt((matrix * matrix).sum(axis=1))[:, None]
                keys = np.empty((len(at), tables), dtype=np.uint64)
                for t in range(tables):
                    draw = np.random.default_rng([_SEED, t])
                    shift = draw.uniform(0, _WIDTH, projections)
                    # drawn by component, so that zeros at the end of a vector do not matter
                    lines = draw.standard_normal((unit.shape[1], projections))
                    cells = np.floor((unit @ lines + shift) / _WIDTH).astype(np.int64).view(np.uint64)
                    keys[:, t] = mixed((cells * steps).sum(axis=1, dtype=np.uint64) + mixed(np.array([t + 1], np.uint64)))
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").take(take), _binary(unit), _binary(keys)], ["node", "unit", "keys"])
    return rows.mapInArrow(run, "node long, unit binary, keys binary")


def _tile_links(members: DataFrame, points: DataFrame, cosine: float, tables: int, tile: int) -> DataFrame:
    """Links within buckets as sums: node, links, and the smallest node it reaches there (`low`).

    A bucket is dealt into tiles by hash and each pair of tiles is one group: a product of two
    small matrices. A pair counts in its first common table only. No pair leaves the task.
    """
    def units_of(values: list[bytes]) -> np.ndarray:
        out = np.zeros((len(values), max(len(v) for v in values) // 8))
        for r, v in enumerate(values):
            out[r, :len(v) // 8] = np.frombuffer(v, "<f8")
        return out

    def sums_of(group: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        i, j, key = (group.column(c)[0].as_py() for c in ("i", "j", "key"))
        side, node = group.column("side").to_numpy(), group.column("node").to_numpy()
        weight = group.column("weight").to_numpy()
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        if not len(left) or not len(right) or len(node) < 2:
            return []
        units = units_of(group.column("unit").to_pylist())
        keys = np.frombuffer(b"".join(group.column("keys").to_pylist()), "<i8").reshape(-1, tables)
        linked = units[left] @ units[right].T >= cosine
        if i == j:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return []
        for t in range(int(np.flatnonzero(keys[0] == key)[0])):
            linked &= keys[left, t][:, None] != keys[right, t][None, :]
        # Components inside the group: the smallest node that each one reaches.
        roots, top = node.copy(), np.iinfo(np.int64).max
        while True:
            before = roots.copy()
            near = np.where(linked, roots[right][None, :], top).min(axis=1)
            roots[left] = np.minimum(roots[left], near)
            near = np.where(linked, roots[left][:, None], top).min(axis=0)
            roots[right] = np.minimum(roots[right], near)
            if (roots == before).all():
                break
        out = [(node[left], linked @ weight[right], roots[left])]
        if i != j:
            out.append((node[right], weight[left] @ linked, roots[right]))
        return [tuple(x[links > 0] for x in (n, links, low)) for n, links, low in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for group in runs(batches, ["key", "i", "j"]):
            found += sums_of(group)
            if len(found) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)],
                                                 ["node", "links", "low"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)],
                                             ["node", "links", "low"])

    dealt = dealt_tiles(members, tile).join(points, "node")
    return in_runs(dealt).mapInArrow(run, "node long, links long, low long")


def duplicate_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                      cosine: float = 0.95, miss: float = 0.002, tile: int = 512) -> DataFrame:
    """Links by cosine: vec_id, n_links, component_id, kept.

    Equal vectors form one class, whose members are linked with each other and share all links.
    Vectors that are null, zero or hold null or non-finite components link with nothing and are
    their own component. Shorter vectors are filled up with zeros. A null id is never the smallest
    unless its component has no other. Repeated rows are vectors of their own. An empty table gives
    an empty result; other columns are not read.
    """
    base = written(rows.select(F.monotonically_increasing_id().alias("node"), F.col(id_col).alias("vec_id"),
                               F.col(vector_col).alias("vector")), "vectors-rows")
    projections, tables = table_plan(base.count(), cosine, miss)
    hashed = written(_hashed(base.select("node", "vector"), projections, tables), "vectors-hashed")
    classes = written(hashed.groupBy("unit").agg(F.min("node").alias("class"), F.count(F.lit(1)).alias("weight")),
                      "vectors-classes").withColumnRenamed("unit", "u")
    points = written(hashed.join(classes.select(F.col("class").alias("node"), "weight"), "node"), "vectors-points")

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), "<i8")
            nodes = np.repeat(batch.column("node").to_numpy(), tables)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(keys)], ["node", "key"])

    keys = written(points.select("node", "keys").mapInArrow(exploded, "node long, key long"), "vectors-keys")
    buckets = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "vectors-buckets")
    found = written(_tile_links(keys.join(buckets, "key"), points, cosine, tables, tile), "vectors-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected(found.where("node != low").select(F.col("node").alias("a"), F.col("low").alias("b")))
    named = written(
        classes.withColumnRenamed("class", "node").join(links, "node", "left").join(roots, "node", "left").select(
            "u", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "node").alias("root")), "vectors-named")
    member = hashed.select("node", F.col("unit").alias("u")).join(named, "u").select("node", "n_links", "root")
    placed = written(base.select("node", "vec_id").join(member, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "node").alias("root")), "vectors-placed")
    smallest = written(placed.groupBy("root").agg(F.min("vec_id").alias("component_id")), "vectors-smallest")
    return placed.join(smallest, "root").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
