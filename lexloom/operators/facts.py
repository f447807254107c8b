"""Availability facts: append-only evidence with a confidence and a time to live; what is known best, now or at a past decision."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators.ordering import grouped_rank
from lexloom.operators.scoring import composite
from lexloom.session import broadcast_if_small

FACT = ("candidate_id", "source", "status", "confidence", "checked_at", "expires_at")


def best_facts(facts: DataFrame, as_of: Column, key: tuple[str, ...] = ("candidate_id",)) -> DataFrame:
    """The fact of highest confidence, then latest check, then source, per candidate, among those not expired at ``as_of``.

    One aggregation keeps the greatest struct per key, combined map-side; a candidate of any weight is no hot spot.
    Expired facts stay in the table: their time to live bounds what may be read, not what is kept.
    """
    rest = [c for c in facts.columns if c not in key]
    readable = facts.where((F.col("checked_at") <= as_of) & (F.col("expires_at") > as_of))
    best = readable.groupBy(*key).agg(F.max(F.struct("confidence", "checked_at", "source", *[c for c in rest if c not in ("confidence", "checked_at", "source")])).alias("_f"))
    return best.select(*key, *[F.col(f"_f.{c}").alias(c) for c in rest])


def facts_at_decisions(facts: DataFrame, decisions: DataFrame, slice_seconds: int = 86_400) -> DataFrame:
    """As-of join: per decision (decision_id, candidate_id, decided_at) the best fact readable then; decisions without one are left out.

    Time is cut into slices, and the whole slices that a fact covers into dyadic stretches (of 1, 2, 4, ... slices), at most two of
    each length, however long it lives. Of all facts of a candidate and stretch only the best matters: these are aggregated
    first, combined map-side, and each decision meets one row per length. Only facts that begin or end in a decision's own slice
    are compared one by one. So a hot candidate's facts and decisions don't meet pairwise.

    Defined cases: null keys or times never match; ties go to the later check, then the greater source and status.
    """
    micros = slice_seconds * 1_000_000
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    number = lambda c: F.floor(at(c) / micros).cast("bigint")
    fact = F.struct("confidence", "checked_at", "source", "status")
    lived = facts.where(F.col("checked_at") < F.col("expires_at")).withColumns({"_from": F.ceil(at("checked_at") / micros).cast("bigint"), "_to": number("expires_at"), "_fact": fact})
    longest = lived.agg(F.max(F.col("_to") - F.col("_from"))).first()[0] or 0
    lengths = range(max(1, int(longest).bit_length()))
    whole = lived.where("_from < _to").select("candidate_id", F.explode(F.filter(F.array(*[s for k in lengths for s in _stretches(k)]), lambda s: s.isNotNull())).alias("_s"), "_fact")
    best = whole.groupBy("candidate_id", "_s").agg(F.max("_fact").alias("_fact"))
    edges = F.filter(F.array_distinct(F.array(number("checked_at"), number("expires_at"))), lambda s: ~((s >= F.col("_from")) & (s < F.col("_to"))))
    part = lived.select("candidate_id", F.explode(edges).alias("_slice"), "_fact", "checked_at", "expires_at")
    asked = decisions.select("decision_id", "candidate_id", "decided_at", number("decided_at").alias("_slice"))
    holding = asked.withColumn("_s", F.explode(F.array(*[F.struct(F.lit(k).alias("length"), F.shiftright("_slice", k).alias("place")) for k in lengths]))).drop("_slice")
    met = best.join(broadcast_if_small(holding), ["candidate_id", "_s"]).select("decision_id", "candidate_id", "decided_at", "_fact").unionByName(
        part.join(broadcast_if_small(asked), ["candidate_id", "_slice"]).where((F.col("checked_at") <= F.col("decided_at")) & (F.col("decided_at") < F.col("expires_at"))).select("decision_id", "candidate_id", "decided_at", "_fact")
    )
    return met.groupBy("decision_id", "candidate_id", "decided_at").agg(F.max("_fact").alias("_f")).select("decision_id", "candidate_id", "decided_at", "_f.*")


def _stretches(k: int) -> list[Column]:
    """The stretches of 2^k slices among those that make up the slices from ``_from`` to before ``_to``: at most one at either end, else null."""
    first, end = -F.shiftright(-F.col("_from"), k), F.shiftright(F.col("_to"), k)
    stretch = lambda place: F.struct(F.lit(k).alias("length"), place.alias("place"))
    return [F.when((first < end) & (F.pmod(first, F.lit(2)) == 1), stretch(first)), F.when((first < end) & (F.pmod(end, F.lit(2)) == 1), stretch(end - 1))]


def cascade(candidates: DataFrame, registered: DataFrame, min_score: float) -> DataFrame:
    """(normalized, score, level): L0 names that are registered stop; of the rest those with a good score go on to the next check."""
    taken = registered.select(F.col("name").alias("normalized"), F.lit(True).alias("_taken")).distinct()
    level = F.when(F.col("_taken"), "taken").when(F.col("score") >= min_score, "promote").otherwise("hold")
    return candidates.join(taken, "normalized", "left").select("normalized", "score", level.alias("level"))


def promote(candidates: DataFrame, registered: DataFrame, facts: DataFrame, min_score: float, verdict_sources: Sequence[str]) -> DataFrame:
    """(normalized, score, level, hint, verdict): how far each candidate goes through the levels of checking, and what is known.

    L0: the set of registered names stops it (``verdict`` taken). L1: a low score holds it there. L2: a hint, the best fact of
    any other source, says free or registered but never decides; L3: only the best fact of a ``verdict_sources`` source does.
    ``facts`` are (normalized, source, status, confidence), one candidate's any number; nothing is deleted.
    """
    decides = F.col("source").isin(*verdict_sources)
    best = lambda wanted: F.max(F.when(wanted, F.struct("confidence", "status")))["status"]
    known = facts.groupBy("normalized").agg(best(~decides).alias("hint"), best(decides).alias("_said"))
    taken = registered.select(F.col("name").alias("normalized"), F.lit(True).alias("_taken")).distinct()
    met = candidates.join(taken, "normalized", "left").join(known, "normalized", "left")
    level = F.when(F.col("_taken"), "L0").when(F.col("score") < min_score, "L1").when(F.col("_said").isNull(), "L2").otherwise("L3")
    verdict = F.when(level == "L0", "taken").when(level == "L3", F.when(F.col("_said") == "registered", "taken").otherwise("free"))
    return met.select("normalized", "score", level.alias("level"), "hint", verdict.alias("verdict"))


def ownability(names: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """``names`` with ``ownability``: the weighted mean of availability (share of free domains), cost (1 for nothing, falling with its logarithm)
    and handles (share of free handles), each a column beside it; what isn't known leaves its weight out."""
    parts = {"availability": F.try_divide("n_free", "n_domains"), "cost": 1 / (1 + F.log10(1 + F.col("cost_cents") / 100)), "handles": F.try_divide("n_free_handles", "n_handles")}
    return composite(names.withColumns({f"{k}_score": c for k, c in parts.items()}), {f"{k}_score": w for k, w in weights.items()}, "ownability")


def sweep_order(facts: DataFrame, as_of: Column, limit: int) -> DataFrame:
    """The ``limit`` candidates to check again first: by score times hours since the last check."""
    last = facts.groupBy("candidate_id").agg(F.max("checked_at").alias("last_checked"), F.max("confidence").alias("score"))
    age = (as_of.cast("timestamp").cast("long") - F.col("last_checked").cast("timestamp").cast("long")) / 3600
    return last.withColumn("priority", F.col("score") * age).orderBy(F.desc("priority"), "candidate_id").limit(limit)


def freshness(facts: DataFrame, as_of: Column) -> DataFrame:
    """(source, last_checked, n_expired) per source."""
    return facts.groupBy("source").agg(F.max("checked_at").alias("last_checked"), F.count_if(F.col("expires_at") <= as_of).alias("n_expired"))


def append(facts: DataFrame, path: str) -> None:
    """Append to the history, partitioned by day of check."""
    facts.withColumn("checked_date", F.to_date("checked_at")).write.mode("append").partitionBy("checked_date").parquet(path)


def write_by_tenant(df: DataFrame, path: str) -> None:
    """Append rows below a folder of their own for each organization_id; a row without one is refused."""
    owned = F.when(F.col("organization_id").isNotNull(), F.col("organization_id")).otherwise(F.raise_error(F.lit("a row belongs to no organization")))
    df.withColumn("organization_id", owned).write.mode("append").partitionBy("organization_id").parquet(path)


def read_of_tenant(spark: SparkSession, path: str, organization_id: str) -> DataFrame:
    """The rows of one organization: the folders of others aren't listed, let alone read."""
    df = spark.read.parquet(path)
    return df.where(F.col("organization_id") == F.lit(organization_id).cast(df.schema["organization_id"].dataType))


def tally(events: DataFrame) -> DataFrame:
    """Votes of an append-only log per candidate and choice, the last of each voter (ties: the greatest choice)."""
    last = events.groupBy("candidate_id", "voter").agg(F.max(F.struct("at", "choice"))["choice"].alias("choice"))
    return last.groupBy("candidate_id", "choice").agg(F.count("*").alias("n_votes"))


def run_costs(calls: DataFrame) -> DataFrame:
    """Calls, tokens and cents per run."""
    return calls.groupBy("run_id").agg(F.count("*").alias("n_calls"), F.sum("tokens").alias("tokens"), F.sum("cost_cents").alias("cost_cents"))


def run_ranking(scores: DataFrame) -> DataFrame:
    """Rank of each candidate within its run; ties share a rank."""
    return grouped_rank(scores, "run_id", "score", "rank")
