"""Exact top-k by inner product: aggregation of sorted lists without random access."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talusflow.llm.common import written
from talusflow.llm.near_duplicates import _binary
from talusflow.llm.vectors import vector_rows

_EXACT = 2.0 ** 52  # doubles add integers exactly below this


def _blocks(rows: DataFrame, scale: float, size: int) -> DataFrame:
    """Usable vectors in blocks: `ids`, `values` (floors of scaled components), `n`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                part = batch.slice(first, size)
                at, matrix = vector_rows(part.column("vector"))
                if len(at):
                    whole = np.floor(matrix * scale)
                    small = np.abs(whole).max(initial=0) < 2**15
                    ids = part.column("id").to_numpy(zero_copy_only=False)[at].astype("<i8")
                    yield pa.RecordBatch.from_arrays(
                        [_binary(ids[None, :]), _binary(whole.astype("<i2" if small else "<f8").reshape(1, -1)),
                         pa.array([small]), pa.array([len(at)], pa.int64())], ["ids", "values", "small", "n"])
    return rows.mapInArrow(run, "ids binary, values binary, small boolean, n long")


def _opened(ids: bytes, values: bytes, small: bool) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(values, "<i2" if small else "<f8").reshape(len(ids), -1).astype(np.float64)


class SortedLists:
    """A block of vectors as one list per component, in falling and in rising order."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.matrix = ids[order], matrix[order]
        self.rank = np.argsort(np.argsort(self.matrix, axis=0, kind="stable"), axis=0, kind="stable")
        self.sorted = np.sort(self.matrix, axis=0)

    def bounds(self, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper scores (vectors x queries) after reading `depth` entries of each list.

        A positive weight reads the falling list, a negative one the rising list. What is not yet
        read of a vector lies between the end of its list and the last entry read.
        """
        n = len(self.matrix)
        known = low = high = 0.0
        for weights, seen, last, end in (
            (np.maximum(queries, 0), self.rank >= n - depth, self.sorted[n - depth], self.sorted[0]),
            (np.minimum(queries, 0), self.rank < depth, self.sorted[depth - 1], self.sorted[-1]),
        ):
            unseen = (~seen).astype(np.float64)
            known = known + (self.matrix * seen) @ weights.T
            low = low + unseen @ (weights * end).T
            high = high + unseen @ (weights * last).T
        return known + low, known + high

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Query number, ids and scores of its best k: ties to the smaller id, never itself.

        Lists are read to an eighth, a quarter, a half, then to the end. A query is done when few
        vectors can still reach its k-th best lower bound; the scores of those are then resolved.
        """
        n = len(self.matrix)
        if np.abs(self.matrix).sum(axis=1).max(initial=0) * max(1.0, np.abs(queries).max(initial=0)) >= _EXACT:
            yield from self._large(query_ids, queries, k)
            return
        left = np.arange(len(queries))
        for share in (8, 4, 2, 1):
            depth = ceil(n / share)
            low, high = self.bounds(queries[left], depth)
            own = self.ids[:, None] == query_ids[left][None, :]
            low[own], high[own] = -np.inf, -np.inf
            bar = np.partition(low, n - min(k, n), axis=0)[n - min(k, n)]
            chance = (high >= bar) & ~own
            done = (chance.sum(axis=0) <= 8 * k) | (share == 1)
            for c in np.flatnonzero(done):
                at = np.flatnonzero(chance[:, c])
                score = self.matrix[at] @ queries[left[c]]
                best = np.lexsort((self.ids[at], -score))[:k]
                yield int(left[c]), self.ids[at[best]], score[best].astype(np.int64)
            left = left[~done]
            if not len(left):
                return

    def _large(self, query_ids, queries, k):
        """Components beyond what doubles add exactly: Python integers, cut to a long's range."""
        whole = [[int(x) for x in row] for row in self.matrix]
        for c, query in enumerate(queries):
            weights = [int(x) for x in query]
            scores = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(row, weights)))), i)
                            for row, i in zip(whole, self.ids.tolist()) if i != query_ids[c])[:k]
            yield c, np.array([i for _, i in scores], np.int64), np.array([-s for s, _ in scores], np.int64)


def top_inner_products(rows: DataFrame, is_query: Column, id_col: str = "vec_id",
                       vector_col: str = "embedding", k: int = 5, scale: float = 256.0,
                       query_block: int = 512, block: int = 2048) -> DataFrame:
    """The k best inner products of each query row: query_id, rank, vec_id, score.

    Vectors count as floor(scale * component). `is_query` refers to the columns of `rows`. Blocks of
    queries meet blocks of rows; each meeting leaves k rows per query, from which a window keeps the
    best. Rows without id, and vectors that are null or hold null or non-finite components, take no
    part. A query never finds its own id; repeated rows of another id are found each. Repeated query
    rows of one id and equal vectors are one query; rows of one id with different vectors are a query
    each, and the ranks of that id come as often. Shorter vectors
    are filled up with zeros. With fewer than k candidates all are returned; an empty table gives
    nothing. Other columns are not read.
    """
    usable = rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    pick = [F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")]
    asked = written(usable.where(is_query).select(*pick).distinct(), "topk-queries")
    parts = max(1, ceil(asked.count() / query_block))
    queries = written(
        _blocks(asked.repartition(parts), scale, query_block)
        .select(*[F.col(c).alias(f"q_{c}") for c in ("ids", "values", "small")],
                F.pmod(F.spark_partition_id(), F.lit(parts)).alias("part"),
                F.monotonically_increasing_id().alias("block")), "topk-query-blocks")
    blocks = written(_blocks(usable.select(*pick), scale, block), "topk-blocks")
    meetings = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).join(queries, "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, lists = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["ids"] != last:
                    last = row["ids"]
                    lists = SortedLists(*_opened(row["ids"], row["values"], row["small"]))
                asking, matrix = _opened(row["q_ids"], row["q_values"], row["q_small"])
                width = max(matrix.shape[1], lists.matrix.shape[1])
                wide = lists
                if lists.matrix.shape[1] < width:
                    wide = SortedLists(lists.ids, np.pad(lists.matrix, ((0, 0), (0, width - lists.matrix.shape[1]))))
                matrix = np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))
                found = list(wide.top(asking, matrix, k))
                counts = [len(ids) for _, ids, _ in found]
                if sum(counts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(asking[[c for c, _, _ in found]], counts)),
                         pa.array(np.repeat([row["block"]], sum(counts))),
                         pa.array(np.repeat(np.array([c for c, _, _ in found], np.int32), counts)),
                         pa.array(np.concatenate([ids for _, ids, _ in found])),
                         pa.array(np.concatenate([s for _, _, s in found]))],
                        ["query_id", "block", "place", "vec_id", "score"])

    found = meetings.mapInArrow(run, "query_id long, block long, place int, vec_id long, score long")
    # A query is its place in its block, not its id.
    best = Window.partitionBy("block", "place").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
