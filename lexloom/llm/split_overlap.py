"""Evaluation records that stand, exactly or almost, in the training split: short records such as names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.text import deletions, name_key, within_one_edit
from lexloom.session import BROADCAST_ROWS, broadcast_if_small, materialise

#: Held-out keys shorter than this must be met exactly.
MIN_ALMOST = 5
#: Held-out keys longer than this are filed by their halves, which are long enough to be rare; shorter ones with each character left out.
MAX_SKIP = 16


def _half(length: Column) -> Column:
    """Characters at the front or at the back that one edit must leave alone (a swap touches two): half of what remains."""
    return F.ceil((length - 2) / 2).cast("int")


def _hashed(kind: str, *parts: Column) -> Column:
    return F.xxhash64(F.lit(kind), *parts)


def _skips(key: Column) -> Column:
    """The hashed n-grams of a key with at most one character left out: two keys one edit apart share one of them."""
    return F.transform(F.array_union(F.array(key), deletions(key)), lambda g: _hashed("skip", g))


def _halves(key: Column, filed_length: Column) -> Column:
    """The hashed front and back half of a key, as a key of ``filed_length`` has them."""
    half = _half(filed_length)
    return F.array(_hashed("front", filed_length, F.substring(key, F.lit(1), half)), _hashed("back", filed_length, F.substring(key, F.length(key) - half + 1, half)))


def evaluation_grams(held_out: DataFrame, min_almost: int = MIN_ALMOST, max_skip: int = MAX_SKIP) -> DataFrame:
    """(eval_key, gram): the hashed n-grams under which each distinct evaluation key is filed."""
    key, length = F.col("eval_key"), F.length("eval_key")
    grams = F.when(length < min_almost, F.array(_hashed("whole", key))).when(length <= max_skip, _skips(key)).otherwise(F.concat(F.array(_hashed("whole", key)), _halves(key, length)))
    return held_out.select("eval_key").distinct().select("eval_key", F.explode(grams).alias("gram"))


def training_grams(key: Column, min_almost: int = MIN_ALMOST, max_skip: int = MAX_SKIP) -> Column:
    """The n-grams under which evaluation keys of the same, one more or one less length may have been filed."""
    length, none = F.length(key), F.array().cast("array<bigint>")
    skips = F.when(length.between(min_almost - 1, max_skip + 1), _skips(key)).otherwise(none)
    halves = [F.when(length + d > max_skip, _halves(key, length + d)).otherwise(none) for d in (-1, 0, 1)]
    return F.array_distinct(F.concat(F.array(_hashed("whole", key)), skips, *halves))


def letter_pairs(key: Column) -> Column:
    framed = F.concat(F.lit("^"), key, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(key) + 1), lambda i: F.substring(framed, i, F.lit(2))))


def candidates(held_out: DataFrame, training: DataFrame, *, min_almost: int = MIN_ALMOST, max_skip: int = MAX_SKIP, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(eval_key, key): the pairs of distinct keys that share an n-gram, each at least once; nearly all of them are overlaps."""
    grams = broadcast_if_small(evaluation_grams(held_out.where(F.col("eval_key") != ""), min_almost, max_skip), broadcast_rows)
    distinct = training.where(F.col("key") != "").select("key").distinct()
    return distinct.select("key", F.explode(training_grams(F.col("key"), min_almost, max_skip)).alias("gram")).join(grams, "gram").select("eval_key", "key")


def overlaps(held_out: DataFrame, training: DataFrame, *, min_almost: int = MIN_ALMOST, max_skip: int = MAX_SKIP, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every evaluation record (eval_id, eval_key) with every training record (found_in, found_key, key) it equals or almost equals.

    Evaluation records are filed under hashed n-grams, broadcast if counted small, else both sides are partitioned by hash;
    each distinct training key is scanned for hits once, however many rows have it. Of each hit the containment is computed:
    the share of the evaluation record's letter pairs that the training record has. One edit costs at most three pairs, so what
    lacks more is out; the exact check of one edit follows. The search is lossless: two keys one edit apart are equal once a
    certain character of either is left out, and of long ones a half is left alone.

    Returns (eval_id, found_in, found_key, match, containment): match is ``exact`` or ``almost``; each pair of records once.
    Defined cases: null or empty keys on either side are ignored; repeated training rows give one result per found_key.
    """
    pairs = (
        candidates(held_out, training, min_almost=min_almost, max_skip=max_skip, broadcast_rows=broadcast_rows)
        .withColumn("_pairs", letter_pairs(F.col("eval_key")))
        .withColumn("_lacking", F.size(F.array_except("_pairs", letter_pairs(F.col("key")))))
        .where(F.col("_lacking") <= 3)
        .withColumn("match", F.when(F.col("key") == F.col("eval_key"), "exact").when((F.length("eval_key") >= min_almost) & within_one_edit(F.col("eval_key"), F.col("key")), "almost"))
        .where(F.col("match").isNotNull())
        .select("eval_key", "key", "match", (1 - F.col("_lacking") / F.size("_pairs")).alias("containment")).distinct()
    )
    met = broadcast_if_small(pairs.join(broadcast_if_small(held_out.select("eval_id", "eval_key"), broadcast_rows), "eval_key").drop("eval_key"), broadcast_rows)
    hits = training.where(F.col("key") != "").select("found_in", "found_key", "key").join(met, "key")
    return hits.groupBy("eval_id", "found_in", "found_key").agg(F.max("match").alias("match"), F.max("containment").alias("containment"))


def holdout_overlaps(holdout: DataFrame, normalised: DataFrame, artifacts: DataFrame) -> DataFrame:
    """``overlaps`` of the held-out names with the names of the training split and of the built artifacts."""
    held_out = holdout.select(F.col("holdout_id").alias("eval_id"), name_key(F.col("name_line")).alias("eval_key"))
    training = normalised.select(
        F.lit("normalised_record").alias("found_in"), F.col("norm_id").cast("string").alias("found_key"), name_key(F.col("normalized")).alias("key")
    ).unionByName(artifacts.select(F.lit("corpus_artifact").alias("found_in"), F.col("artifact_id").alias("found_key"), F.explode("names").alias("name")).select(
        "found_in", "found_key", name_key(F.col("name")).alias("key")
    ))
    # Keys are worked out once: both the search and the rows of what it found read them.
    return overlaps(materialise(held_out, "held-out"), materialise(training, "training"))


def per_split_and_source(found: DataFrame, holdout: DataFrame) -> DataFrame:
    """Overlaps counted per split, source, table and kind; null split or source as ``unknown``."""
    named = holdout.select(
        F.col("holdout_id").alias("eval_id"), F.coalesce("split_name", F.lit("unknown")).alias("split_name"), F.coalesce("source_name", F.lit("unknown")).alias("source_name")
    )
    return found.join(named, "eval_id").groupBy("split_name", "source_name", "found_in", "match").agg(
        F.count_distinct("eval_id").alias("n_held_out"), F.count("*").alias("n_overlaps")
    )


def artifact_claims(found: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Per artifact the held-out names found in it beside what its build says it excluded (null claim: none was made)."""
    by_artifact = found.where(F.col("found_in") == "corpus_artifact").groupBy(F.col("found_key").alias("artifact_id")).agg(F.count_distinct("eval_id").alias("n_found"))
    claimed = F.aggregate(F.map_values("excluded_by_holdout"), F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0).cast("bigint")))
    return artifacts.select("artifact_id", "use_kind", claimed.alias("n_claimed")).join(by_artifact, "artifact_id", "left").select(
        "artifact_id", "use_kind", "n_claimed", F.coalesce("n_found", F.lit(0)).alias("n_found")
    )
