"""Evidence per name and provider, and what follows from it per name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.operators.normalise import TAGS
from lexloom.operators.ordering import running_total
from lexloom.session import with_row


def saturation(accepted: DataFrame) -> DataFrame:
    """(normalized, provider_id, record_count, live, dead, earliest_year, latest_year): evidence kept by provider.

    All buffers are fixed-width, so the aggregation stays hashed and combines map-side. Unknown status counts in neither
    live nor dead; the years ignore nulls and are null where all are.
    """
    return accepted.groupBy("normalized", "provider_id").agg(
        F.count("*").alias("record_count"), F.count_if(F.col("status") == "live").alias("live"), F.count_if(F.col("status") == "dead").alias("dead"),
        F.min("first_seen_year").alias("earliest_year"), F.max("first_seen_year").alias("latest_year"),
    )


def convergence(by_provider: DataFrame) -> DataFrame:
    """(normalized, convergent_provider_count, total_count, earliest_year) from ``saturation``."""
    return by_provider.groupBy("normalized").agg(
        F.count("*").alias("convergent_provider_count"), F.sum("record_count").alias("total_count"), F.min("earliest_year").alias("earliest_year")
    )


def name_flags(tagged: DataFrame) -> DataFrame:
    """(normalized, one flag per tag): a tag holds for a name if any of its records has it."""
    return tagged.groupBy("normalized").agg(*[F.bool_or(t).alias(t) for t in TAGS])


def first_display(accepted: DataFrame, ordinal: str) -> DataFrame:
    """(normalized, display) of the record with the smallest ordinal.

    The smallest ordinal is found by a hashed aggregation over numbers; the text is joined back for these rows only.
    """
    first = accepted.groupBy("normalized").agg(F.min(ordinal).alias(ordinal))
    return accepted.select("normalized", ordinal, "display").join(first, ["normalized", ordinal]).groupBy("normalized").agg(F.min("display").alias("display"))


def name_categories(accepted: DataFrame) -> DataFrame:
    """(normalized, category, n_records): long form of the categories' histogram; null categories have no row."""
    return accepted.select("normalized", F.explode("categories").alias("category")).where(F.col("category").isNotNull()).groupBy("normalized", "category").agg(
        F.count("*").alias("n_records")
    )


def category_union(accepted: DataFrame) -> DataFrame:
    """(normalized, categories) as one sorted, comma-separated string; a name's categories are as many as the classes, not as its rows."""
    return name_categories(accepted).groupBy("normalized").agg(F.array_join(F.array_sort(F.collect_list("category")), ",").alias("categories"))


def from_counts(partial: DataFrame) -> DataFrame:
    """Saturation from partial counts of several runs: rows delivered twice count once, nulls as 0."""
    return partial.distinct().groupBy("normalized", "provider_id").agg(
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("record_count", "live", "dead")], F.min("earliest_year").alias("earliest_year")
    )


def duplicate_ids(df: DataFrame, id_column: str) -> DataFrame:
    """Values that stand more than once."""
    return df.groupBy(id_column).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def saturation_percentile(totals: DataFrame) -> DataFrame:
    """(normalized, total_count, percentile): the share of names with a smaller total.

    Names are grouped by total first; the running count over the distinct totals is split by ranges.
    """
    by_total = totals.groupBy("total_count").agg(F.count("*").alias("_n"))
    everything = totals.agg(F.count("*").alias("_all"))
    ranks = with_row(running_total(by_total, "total_count", F.col("_n"), "_below"), everything)
    share = F.when(F.col("_all") > 1, F.col("_below") / (F.col("_all") - 1)).otherwise(0.0)
    return totals.join(ranks.select("total_count", share.alias("percentile")), "total_count").select("normalized", "total_count", "percentile")
