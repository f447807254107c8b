"""Approximate membership in large sets: a Bloom filter as a table, asked by one equality join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.session import broadcast_if_small

#: A block is eight words of 64 bits; all bits of a key lie in one block.
WORDS = 8
BITS_PER_KEY = 16
HASHES = 8


def _place(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(n_blocks))


def _masks(key: Column) -> list[Column]:
    """The bits of a key in each of the eight words of its block."""
    bits = [F.pmod(F.xxhash64(F.lit(f"bit {i}"), key), F.lit(64 * WORDS)) for i in range(HASHES)]
    one = F.lit(1).cast("bigint")
    return [
        _either([F.when(F.floor(b / 64) == w, F.call_function("shiftleft", one, (b % 64).cast("int"))).otherwise(F.lit(0).cast("bigint")) for b in bits]) for w in range(WORDS)
    ]


def _either(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out.bitwiseOR(c)
    return out


def blocks_for(n_keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    return max(1, math.ceil(n_keys * bits_per_key / (64 * WORDS)))


def bloom_filter(names: DataFrame, name: str, n_blocks: int) -> DataFrame:
    """(block, w0, ..., w7): the filter of a column's values, one row per block in use; equal for any order or repetition of rows.

    Bits are combined by OR, map-side first. Filters of one ``n_blocks`` can be united by the same OR. Null values aren't in it.
    """
    key = F.col(name)
    marked = names.where(key.isNotNull()).select(_place(key, n_blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(key))])
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def might_hold(names: DataFrame, name: str, bloom: DataFrame, n_blocks: int, flag: str = "might_hold") -> DataFrame:
    """``names`` with whether the filter may hold each value: false is certain, true is wrong for about one in a thousand at 16 bits a key."""
    key = F.col(name)
    asked = names.withColumn("_block", _place(key, n_blocks)).join(broadcast_if_small(bloom.withColumnRenamed("block", "_block")), "_block", "left")
    held = F.lit(True)
    for i, m in enumerate(_masks(key)):
        held = held & (F.coalesce(f"w{i}", F.lit(0).cast("bigint")).bitwiseAND(m) == m)
    return asked.withColumn(flag, held & key.isNotNull()).drop("_block", *[f"w{i}" for i in range(WORDS)])
