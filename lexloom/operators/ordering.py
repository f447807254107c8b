"""Ranks and running totals over any number of values, without a window over all rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.session import materialise


def running_totals(df: DataFrame, order: str, amounts: Mapping[str, Column]) -> DataFrame:
    """``df`` with, for each of ``amounts`` (name to amount), its sum over the rows before each, by ascending ``order``; ``order`` must be distinct.

    Rows are partitioned by ranges of ``order`` and written; the totals of the ranges - one row per partition - are added up
    first, then each range adds up its own rows in parallel. Null values come first.
    """
    held = {name: f"_amount{i}" for i, name in enumerate(amounts)}
    ranged = df.withColumns({held[n]: c for n, c in amounts.items()}).repartitionByRange(F.col(order).asc_nulls_first()).withColumn("_range", F.spark_partition_id())
    kept = materialise(ranged, "ranges")
    ranges = kept.groupBy("_range").agg(*[F.sum(h).alias(h) for h in held.values()])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("_range", *[F.coalesce(F.sum(h).over(earlier), F.lit(0)).alias(f"_offset{h}") for h in held.values()])
    within = Window.partitionBy("_range").orderBy(F.col(order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    joined = kept.join(F.broadcast(offsets), "_range")
    added = joined.select("*", *[(F.col(f"_offset{h}") + F.coalesce(F.sum(h).over(within), F.lit(0))).alias(n) for n, h in held.items()])
    return added.drop("_range", *held.values(), *[f"_offset{h}" for h in held.values()])


def running_total(df: DataFrame, order: str, amount: Column, name: str) -> DataFrame:
    """``running_totals`` of one amount."""
    return running_totals(df, order, {name: amount})


def joined_in_order(names: DataFrame, column: str, separator: str) -> Iterator[tuple[int, str]]:
    """The values of a text column in ascending order, as (how many, joined text) of some thousands at a time.

    For what is one sequence by its definition, such as a hash over all names: sorted by ranges and joined on the executors, handed to
    the driver a partition at a time, never held together.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int32()), pa.array([separator.join(batch.column(0).to_pylist())])], names=["n", "text"])

    for row in names.select(column).orderBy(column).mapInArrow(joined, "n int, text string").toLocalIterator(prefetchPartitions=True):
        yield row["n"], row["text"]


def quantile(df: DataFrame, value: str, q: float, name: str) -> DataFrame:
    """One row: the exact ``q`` quantile of a number, between two values in proportion; null values don't count, null of nothing.

    Equal values are counted first, and their running count is split by ranges: no task holds the distinct values.
    """
    by_value = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_m"))
    ranked = running_total(by_value, "_v", F.col("_m"), "_before")
    at = ranked.agg(F.sum("_m").alias("_n")).select(((F.col("_n") - 1) * q).alias("_at")).scalar()
    low, high = F.floor(at), F.ceil(at)
    holds = lambda place: (F.col("_before") <= place) & (place < F.col("_before") + F.col("_m"))
    ends = ranked.agg(F.max(F.when(holds(low), F.col("_v"))).alias("_low"), F.max(F.when(holds(high), F.col("_v"))).alias("_high"))
    return ends.select((F.col("_low") + (F.col("_high") - F.col("_low")) * (at - low)).alias(name))


def grouped_rank(df: DataFrame, group: str, by: str, name: str) -> DataFrame:
    """``df`` with its rank within ``group`` by falling ``by``, ties sharing a rank, nulls last; a group may hold most rows.

    Equal values of a group are counted first; the running count over (group, value) is split by ranges, and what stands
    before a group is taken off again. No window runs over a group.
    """
    by_value = df.groupBy(group, by).agg(F.count("*").alias("_m")).withColumn("_key", F.struct(F.col(group), F.col(by).isNull(), -F.col(by).cast("double")))
    counted = running_total(by_value, "_key", F.col("_m"), "_before").drop("_key", "_m")
    starts = counted.groupBy(F.col(group).alias("_group")).agg(F.min("_before").alias("_start"))
    ranks = counted.join(starts, F.col(group).eqNullSafe(F.col("_group"))).select(F.col(group).alias("_group"), F.col(by).alias("_by"), (F.col("_before") - F.col("_start") + 1).alias(name))
    return df.join(ranks, df[group].eqNullSafe(ranks["_group"]) & df[by].eqNullSafe(ranks["_by"])).drop("_group", "_by")
