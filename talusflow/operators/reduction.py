"""Reducing a large table to the keys another one has, before it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26  # 8 MB of bits, at most 2^20 rows of 64


def _place(key: str | Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_bits(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The bits that the keys set by their hash: (word, mask), at most `bits` / 64 rows.

    That bound holds for any number of keys. Partial masks are combined before the shuffle.
    """
    return keys.select(_place(key, bits).alias("_at")).groupBy(
        F.shiftright("_at", 6).alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(_at % 64 AS INT)))").alias("_mask"))


def likely_keys(df: DataFrame, key: str, marked: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows whose key may be among the marked ones: all that are, and a share of the others.

    With n keys marked a row of another key stays with probability 1 - exp(-n / bits), so what
    follows still has to join exactly. The bits are broadcast; `key_bits` bounds their size.
    """
    at = _place(key, bits)
    there = F.col("_mask").bitwiseAND(F.expr("shiftleft(1L, CAST(_at % 64 AS INT))")) != 0
    return df.withColumn("_at", at).withColumn("_word", F.shiftright("_at", 6)).join(
        F.broadcast(marked), "_word").where(there).select(*df.columns)
