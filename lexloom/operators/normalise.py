"""Structural rules, tags, the rejection side and the funnel - all columns of one scan.

Nothing is discarded silently: a rejected row keeps the first rule it failed, everything short of that is a tag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.text import WHITESPACE, strip
from lexloom.session import broadcast_if_small

# They must equal those the corpus was specified with.
MIN_LENGTH = 3
MAX_LENGTH = 16
LEGAL_ENTITY_TOKENS = ("inc", "llc", "ltd", "corp", "co", "plc", "gmbh", "sa", "bv", "ag", "nv", "srl", "oy", "ab")
VOWELS = "aeiouy"


def rules(raw: Column) -> list[tuple[str, Column]]:
    """The structural rules on stripped text, cheapest first; the first that holds rejects."""
    return [
        ("empty_text", raw == ""),
        ("multi_token", raw.rlike(f"(?U){WHITESPACE}")),
        ("non_alphabetic", ~raw.rlike(r"^[A-Za-z]+\z")),
        ("too_short", F.length(raw) < MIN_LENGTH),
        ("too_long", F.length(raw) > MAX_LENGTH),
        ("legal_entity_artifact", F.lower(raw).isin(*LEGAL_ENTITY_TOKENS)),
    ]


def rejection_rule(raw: Column, extra: Sequence[tuple[str, Column]] = ()) -> Column:
    """The first rule that rejects, null if none; ``extra`` rules come last."""
    chain = F
    for name, fails in [*rules(raw), *extra]:
        chain = chain.when(fails, name)
    return chain


def classified(records: DataFrame, extra: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """Records with ``display`` (stripped text), ``normalized`` and ``rejection_rule``. Null text counts as empty."""
    return (
        records.withColumn("display", strip(F.coalesce("text", F.lit(""))))
        .withColumn("normalized", F.lower("display"))
        .withColumn("rejection_rule", rejection_rule(F.col("display"), extra))
    )


def status_of(c: Column) -> Column:
    """live, dead or unknown from any spelling of these words."""
    clean = F.lower(strip(c))
    return F.when(clean.isin("live", "dead"), clean).otherwise("unknown")


def _listed(df: DataFrame, lexicon: DataFrame | None, flag: str) -> DataFrame:
    if lexicon is None:
        return df.withColumn(flag, F.lit(False))
    words = lexicon.select(F.lower(lexicon.columns[0]).alias("normalized")).where("normalized is not null").distinct().withColumn(flag, F.lit(True))
    return df.join(broadcast_if_small(words), "normalized", "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def tagged(accepted: DataFrame, dictionary: DataFrame | None = None, profanity: DataFrame | None = None) -> DataFrame:
    """Accepted records with a flag per tag. The lexicons are one-column DataFrames, or left out.

    A record is international if its field of that name holds any text at all.
    """
    df = _listed(_listed(accepted, dictionary, "dictionary_word"), profanity, "profanity_signal")
    return df.withColumns({
        "probable_acronym": ~F.col("normalized").rlike(f"[{VOWELS}]"),
        "live_registration": F.col("status") == "live",
        "abandoned": F.col("status") == "dead",
        "international_registration": F.coalesce(F.try_element_at("source_fields", F.lit("international_registration")) != "", F.lit(False)),
    })


TAGS = ("abandoned", "dictionary_word", "international_registration", "live_registration", "probable_acronym", "profanity_signal")


def normalise(records: DataFrame, dictionary: DataFrame | None = None, profanity: DataFrame | None = None) -> DataFrame:
    """The accepted records, tagged, tags also as a sorted array; display keeps the source's casing."""
    known = classified(records.withColumn("status", status_of(F.col("status")))).where(F.col("rejection_rule").isNull())
    return tagged(known, dictionary, profanity).withColumn("tags", F.filter(F.array(*[F.when(F.col(t), F.lit(t)) for t in TAGS]), lambda x: x.isNotNull()))


def rejections(records: DataFrame) -> DataFrame:
    """(rule, detail, provider_id, source_ref) of each rejected record; the detail of empty text is ``<empty>``."""
    return classified(records).where(F.col("rejection_rule").isNotNull()).select(
        F.col("rejection_rule").alias("rule"), F.when(F.col("display") == "", "<empty>").otherwise(F.col("display")).alias("detail"), "provider_id", "source_ref"
    )


def funnel(records: DataFrame) -> DataFrame:
    """Per provider: extracted, accepted, distinct, rejected by rule, rejected_total and acceptance_rate (0 of nothing).

    extracted = accepted + rejected_total always holds. Distinct names are grouped before they are counted, so no task
    holds the set of a provider's names.
    """
    known = classified(records)
    names = [r for r, _ in rules(F.lit(""))]
    by_name = known.groupBy("provider_id", F.when(F.col("rejection_rule").isNull(), F.col("normalized")).alias("_name")).agg(
        F.count("*").alias("_n"), *[F.count_if(F.col("rejection_rule") == r).alias(r) for r in names]
    )
    counted = by_name.groupBy("provider_id").agg(
        F.sum("_n").alias("extracted"), F.coalesce(F.sum(F.when(F.col("_name").isNotNull(), F.col("_n"))), F.lit(0)).alias("accepted"),
        F.count("_name").alias("distinct_names"), *[F.sum(r).alias(r) for r in names],
    )
    total = F.col("extracted") - F.col("accepted")
    return counted.withColumn("rejected_total", total).withColumn("acceptance_rate", F.coalesce(F.try_divide("accepted", "extracted"), F.lit(0.0)))


def rejection_histogram(records: DataFrame) -> DataFrame:
    """Rejected records by rule, most first."""
    return rejections(records).groupBy("rule").agg(F.count("*").alias("n_rejected")).orderBy(F.desc("n_rejected"), "rule")


def funnel_rollup(records: DataFrame) -> DataFrame:
    """Rows by provider and outcome with subtotals; ``all`` stands for the total."""
    known = classified(records).select("provider_id", F.coalesce("rejection_rule", F.lit("accepted")).alias("outcome"))
    return known.rollup("provider_id", "outcome").agg(F.count("*").alias("n_rows"), F.grouping_id().alias("level")).select(
        F.when(F.col("level") >= 3, "all").otherwise(F.col("provider_id")).alias("provider_id"),
        F.when(F.col("level") >= 1, "all").otherwise(F.col("outcome")).alias("outcome"), "n_rows",
    )


def render_funnel(row) -> str:
    """A funnel row as text: rules by falling count, then by name."""
    counts = sorted(((row[r], r) for r, _ in rules(F.lit("")) if row[r]), key=lambda x: (-x[0], x[1]))
    lines = [f"{row['provider_id']}: extracted {row['extracted']}, accepted {row['accepted']} ({row['acceptance_rate']:.1%}), distinct {row['distinct_names']}"]
    return "\n".join(lines + [f"  {rule}: {n}" for n, rule in counts])


def tiers(records: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """(record columns, tier): A a live standard-character single word of 4 to 14 letters, neither dictionary word nor acronym; B any other
    accepted name; C a name of several words; null for the rest."""
    known = classified(records.withColumn("status", status_of(F.col("status"))))
    known = tagged(known, dictionary)
    standard = F.coalesce(F.try_element_at("source_fields", F.lit("drawing_code")).isin("4", "5"), F.lit(False))
    best = F.col("live_registration") & standard & F.length("normalized").between(4, 14) & ~F.col("dictionary_word") & ~F.col("probable_acronym")
    return known.withColumn("tier", F.when(F.col("rejection_rule").isNull() & best, "A").when(F.col("rejection_rule").isNull(), "B").when(F.col("rejection_rule") == "multi_token", "C"))


def brief_filter(names: DataFrame, *, must_include: str | None = None, must_avoid: Sequence[str] = (), length: tuple[int, int] = (0, 1 << 30)) -> DataFrame:
    """Names that hold one string, hold none of others and are within a range of lengths."""
    kept = F.length("normalized").between(*length)
    if must_include:
        kept &= F.col("normalized").contains(must_include)
    for word in must_avoid:
        kept &= ~F.col("normalized").contains(word)
    return names.where(kept)
