"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talusflow.session import shared_path, work_folder

# What the contracts call white space, and a word.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"


def written(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """The frame, written to the shared folder and read back: later stages start from the files.

    Without a `compression` the session's codec is taken.
    """
    path = shared_path(df.sparkSession, purpose)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, purpose: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What `make` returns, written to the shared folder; all that is written on the way is deleted."""
    path = shared_path(spark, purpose)
    with work_folder(spark):
        result = make()
        result.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(result.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_remainder(id_col: str, divisor: int) -> Column:
    """crc32 of an id's decimal text, modulo `divisor`; a null id counts as empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(divisor)


def runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """The groups of rows that are equal in the integer columns `by`; the rows come sorted by them."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        if not rows.num_rows:
            continue
        change = np.zeros(rows.num_rows - 1, dtype=bool)
        for name in by:
            values = rows.column(name).to_numpy()
            change |= values[1:] != values[:-1]
        cuts = np.r_[0, np.flatnonzero(change) + 1]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield rows.slice(a, b - a)
        held = rows.slice(cuts[-1])
    if held is not None:
        yield held


def dealt_tiles(members: DataFrame, tile: int, *more: str) -> DataFrame:
    """Buckets (key, node, n rows) dealt into tiles by hash: a row for each pair of tiles it is in.

    `i` <= `j` name the pair, `side` the node's own tile. Rows of a pair end up together and in
    order: partitioned and sorted by key, i, j.
    """
    return (
        members.withColumn("_tiles", F.ceil(F.col("n") / tile).cast("int"))
        .withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_tiles")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
        .select("key", "node", *more, F.least("_own", "_other").alias("i"),
                F.greatest("_own", "_other").alias("j"), F.col("_own").alias("side")))


def in_runs(dealt: DataFrame, parts: int | None = None) -> DataFrame:
    """Pairs of tiles as runs of rows, in `parts` tasks; without a number bytes decide, not work."""
    groups = ["key", "i", "j"]
    spread = dealt.repartition(parts, *groups) if parts else dealt.repartition(*groups)
    return spread.sortWithinPartitions(*groups, "node")


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_POWER_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_INVERSE_STEP = np.uint64(pow(int(_POWER_STEP), -1, 1 << 64))
_tables: dict[int, np.ndarray] = {}


def _powers(step: np.uint64, n: int) -> np.ndarray:
    """The first `n` powers of a step modulo 2^64, kept for later runs."""
    known = _tables.get(int(step))
    if known is None or len(known) < n:
        size = max(n, 1 << 21)
        known = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, step)], dtype=np.uint64)
        if size == 1 << 21:
            _tables[int(step)] = known
    return known[:n]


def text_chunks(column: pa.Array, budget: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `budget` bytes: first row, end row, bytes, offsets from 0.

    Nulls are empty texts. A single longer text forms a run of its own.
    """
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + budget, side="right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def hashed_words(data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = ()
                 ) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """64-bit hashes of the words of a run of texts, and each text's share of them.

    Returns hashes, text bounds (len(offsets)), and for each length in `prefixes` the hashes of the
    words' first bytes. Letters A-Z are lowered first. A hash is a polynomial of coded bytes modulo 2^64, mixed at the end, so all
    words of a run come from one running sum.
    """
    n = len(data)
    if n == 0:
        empty = np.empty(0, np.uint64)
        return empty, np.zeros(len(offsets), np.int64), [empty] * len(prefixes)
    inside = np.empty(n + 1, dtype=bool)
    np.logical_not(_IS_SPACE[data], out=inside[:n])
    inside[n] = False
    begins = inside[:n].copy()
    begins[1:] &= ~inside[:n - 1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    stops = inside[:n] & ~inside[1:]
    before = cuts[cuts > 0] - 1
    stops[before] = inside[before]
    ends = np.flatnonzero(stops) + 1
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_CODES[_LOWER[data]] * _powers(_POWER_STEP, n), out=sums[1:])
    back = _powers(_INVERSE_STEP, n)[starts]
    hashes = [mixed((sums[stop] - sums[starts]) * back)
              for stop in (ends, *(np.minimum(starts + k, ends) for k in prefixes))]
    return hashes[0], np.searchsorted(starts, offsets), hashes[1:]


class Lookup:
    """Rows of values by 64-bit key; keys that are not there get the default row."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: tuple[float, ...]):
        order = np.argsort(keys)
        self.keys = np.r_[keys[order], np.uint64(2**64 - 1)]
        self.values = np.vstack([values[order].reshape(len(keys), len(default)), default]).astype(np.float32)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys[:-1], keys)
        return self.values[np.where(self.keys[at] == keys, at, len(self.keys) - 1)]
