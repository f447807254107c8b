"""Index-addressable enumeration: every candidate is a number, and every number can be decoded anywhere."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.session import ship, with_row

SLOTS = 1024


def enumerate_range(spark: SparkSession, start: int, end: int, partitions: int | None = None) -> DataFrame:
    """The indices (column idx) from start to before end; any split of a range gives the same rows."""
    return spark.range(start, end, 1, partitions).withColumnRenamed("id", "idx")


def decode(idx: Column, radices: Sequence[int]) -> list[Column]:
    """The mixed-radix digits of an index, least significant first."""
    digits, below = [], 1
    for r in radices:
        digits.append(F.pmod(F.floor(idx / F.lit(below)) if below > 1 else idx, F.lit(r)).cast("int"))
        below *= r
    return digits


def encode(digits: Sequence[Column], radices: Sequence[int]) -> Column:
    """The index of digits: the inverse of ``decode``."""
    out, below = F.lit(0).cast("bigint"), 1
    for d, r in zip(digits, radices, strict=True):
        out, below = out + d.cast("bigint") * below, below * r
    return out


def slots(weights: DataFrame, total: int = SLOTS) -> DataFrame:
    """(choice, first_slot, n_slots): weights (choice, weight) as whole numbers of slots that add up to ``total``.

    Shares are rounded down; what remains goes to the largest remainders, then by name. The choices of one position are few.
    """
    from pyspark.sql import Window

    everything = weights.agg(F.sum("weight").alias("_sum"))
    exact = with_row(weights, everything).withColumn("_e", F.col("weight") * total / F.col("_sum")).withColumn("_f", F.floor("_e").cast("bigint"))
    by_rest, by_name, whole = Window.orderBy(F.desc(F.round(F.col("_e") - F.col("_f"), 9)), "choice"), Window.orderBy("choice"), Window.partitionBy()
    left = exact.withColumn("_left", F.lit(total) - F.sum("_f").over(whole)).withColumn("n_slots", F.col("_f") + F.when(F.row_number().over(by_rest) <= F.col("_left"), 1).otherwise(0))
    return left.select("choice", (F.sum("n_slots").over(by_name) - F.col("n_slots")).alias("first_slot"), "n_slots")


def slot_table(expanded: DataFrame) -> DataFrame:
    """(slot, choice): a row per slot, for equality joins."""
    return expanded.where("n_slots > 0").select(F.explode(F.sequence(F.col("first_slot"), F.col("first_slot") + F.col("n_slots") - 1)).alias("slot"), "choice")


def permute(values: np.ndarray, size: int, key: int, rounds: int = 4) -> np.ndarray:
    """A keyed bijection on [0, size): a balanced Feistel network on the next even number of bits, walked until back in range."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}/{r}".encode(), digest_size=8).digest(), "big")) for r in range(rounds)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            z = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            z ^= z >> np.uint64(29)
            z *= np.uint64(0xBF58476D1CE4E5B9)
            z ^= z >> np.uint64(32)
            left, right = right, left ^ (z & mask)
        return (left << np.uint64(half)) | right

    out = once(values.astype(np.uint64))
    while (outside := out >= np.uint64(size)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def permuted(idx: Column, size: int, key: int) -> Column:
    """``permute`` as a column: an Arrow UDF, as the walk depends on the data."""

    @F.pandas_udf("bigint")
    def walked(s: pd.Series) -> pd.Series:
        return pd.Series(permute(s.to_numpy(), size, key))

    ship(SparkSession.active())
    return walked(idx)


def space_id(ruleset: Mapping) -> str:
    """Content address of a ruleset: any change that counts mints a new space."""
    return "space1:" + hashlib.sha256(json.dumps(ruleset, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:32]


def compatible(old: Mapping[str, Sequence], new: Mapping[str, Sequence]) -> bool:
    """Whether old indices decode alike in a new version: every position's choices are those of the old one, in order."""
    return list(old) == list(new) and all(list(new[p]) == list(old[p]) for p in old)


def build(indices: DataFrame, positions: Mapping[str, Sequence[str]], key: int | None = None) -> DataFrame:
    """(idx, surface): indices decoded through one inventory per position and joined to a surface; a total function.

    Inventories are literal arrays, so no join is needed; ``key`` permutes the space first.
    """
    radices = [len(choices) for choices in positions.values()]
    size = int(np.prod(radices))
    at = F.pmod("idx", F.lit(size)) if key is None else permuted(F.pmod("idx", F.lit(size)), size, key)
    df = indices.withColumn("_at", at)
    parts = [F.get(F.array(*[F.lit(c) for c in choices]), digit) for choices, digit in zip(positions.values(), decode(F.col("_at"), radices), strict=True)]
    return df.withColumn("surface", F.concat(*parts)).drop("_at")


def replay_failures(stored: DataFrame, positions: Mapping[str, Sequence[str]], key: int | None = None) -> DataFrame:
    """Stored (idx, surface) that don't come out again."""
    again = build(stored.select("idx", F.col("surface").alias("_was")), positions, key)
    return again.where(~F.col("surface").eqNullSafe(F.col("_was"))).select("idx", F.col("_was").alias("stored"), F.col("surface").alias("replayed"))


def duplicates(built: DataFrame) -> DataFrame:
    """Surfaces with more than one derivation, and how many."""
    return built.groupBy("surface").agg(F.count("*").alias("n_derivations")).where("n_derivations > 1")


def fingerprint(built: DataFrame) -> DataFrame:
    """One row that any sharding of the same rows shares: count and an order-free sum of row hashes."""
    h = F.pmod(F.xxhash64("idx", "surface"), F.lit(1 << 40))
    return built.agg(F.count("*").alias("n_rows"), F.sum(h).alias("hash_sum"))


def subspace(positions: Mapping[str, Sequence[str]], allowed: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """The positions with only the choices a brief allows, in their order; a smaller space with an id of its own."""
    return {p: [c for c in choices if c in set(allowed.get(p, choices))] for p, choices in positions.items()}


def manifest(spark: SparkSession, run_id: str, **inputs: str) -> DataFrame:
    """One row per input of a run (engine, ruleset, seed, corpus hashes, ...), with a hash of them all: written beside every output."""
    digest = hashlib.sha256(json.dumps(inputs, sort_keys=True).encode()).hexdigest()
    return spark.createDataFrame([(run_id, k, str(v), f"sha256:{digest}") for k, v in sorted(inputs.items())], "run_id string, input string, value string, manifest_hash string")
