"""Signals of collision between candidates and marks, and distances to a corpus. Evidence only: no verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.phonetic import phonetic_key
from lexloom.operators.holdout import deletion_keys
from lexloom.operators.ordering import quantile
from lexloom.session import broadcast_if_small, materialise, with_row


def signals(candidates: DataFrame, marks: DataFrame, phonetic: bool = True) -> DataFrame:
    """(candidate, mark, match_type, similarity) by equality of names, of sounds and of deletion keys: three equality joins.

    ``candidates`` and ``marks`` have one column, normalized. similarity is 1 less the edit distance over the greater length.
    """
    c, m = candidates.select(F.col("normalized").alias("candidate")).distinct(), marks.select(F.col("normalized").alias("mark")).distinct()
    near = (
        c.select("candidate", F.explode(deletion_keys(F.col("candidate"))).alias("k"))
        .join(broadcast_if_small(m.select("mark", F.explode(deletion_keys(F.col("mark"))).alias("k"))), "k").select("candidate", "mark").distinct()
        .withColumn("match_type", F.when(F.col("candidate") == F.col("mark"), "exact").otherwise("edit_distance"))
    )
    if phonetic:
        sound = c.withColumn("code", phonetic_key(F.col("candidate"))).where("code <> ''").join(broadcast_if_small(m.withColumn("code", phonetic_key(F.col("mark")))), "code")
        near = near.unionByName(sound.where(F.col("candidate") != F.col("mark")).select("candidate", "mark", F.lit("phonetic").alias("match_type")))
    return near.withColumn("similarity", 1 - F.levenshtein("candidate", "mark") / F.greatest(F.length("candidate"), F.length("mark")))


def signal_counts(found: DataFrame) -> DataFrame:
    """Signals per candidate and kind; no verdict."""
    return found.groupBy("candidate", "match_type").agg(F.count("*").alias("n_signals"), F.max("similarity").alias("best_similarity"))


def signal_counts_by_class(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Signals per candidate, kind and class of goods (``classes``: mark, class; a mark may have several), and the closest of each; marks without a class as ``none``."""
    known = found.join(classes.select("mark", "class").where("class is not null").distinct(), "mark", "left").withColumn("class", F.coalesce("class", F.lit("none")))
    return known.groupBy("candidate", "match_type", "class").agg(F.count("*").alias("n_signals"), F.max("similarity").alias("best_similarity"))


def collision_gate(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """(normalized, collides): candidates that are a real word or a known brand (``words``, column normalized), or sound like one: word, sound, or null for none."""
    c, w = candidates.select("normalized").distinct(), words.select("normalized").where(F.col("normalized").isNotNull()).distinct()
    heard = w.select(phonetic_key(F.col("normalized")).alias("_code")).where("_code <> ''").distinct().withColumn("_heard", F.lit(True))
    met = c.withColumn("_code", phonetic_key(F.col("normalized"))).join(broadcast_if_small(w.withColumn("_read", F.lit(True))), "normalized", "left").join(broadcast_if_small(heard), "_code", "left")
    return met.select("normalized", F.when(F.col("_read"), "word").when(F.col("_heard"), "sound").alias("collides"))


def lexicon_gate(candidates: DataFrame, lexicon: DataFrame, severity: str = "blocking") -> DataFrame:
    """Candidates that no language's lexicon (word, language, severity) blocks."""
    blocked = lexicon.where(F.col("severity") == severity).select(F.lower("word").alias("normalized")).distinct()
    return candidates.join(broadcast_if_small(blocked), "normalized", "left_anti")


def _pieces(name: Column, n: Column, width: int) -> Column:
    """All stretches of one width with their places."""
    return F.transform(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), lambda at: F.struct(at.cast("int").alias("pos"), F.substring(name, at + 1, F.lit(width)).alias("piece")))


def distances_within(candidates: DataFrame, corpus: DataFrame, most: int = 2, max_length: int = 16) -> DataFrame:
    """(normalized, min_distance): the least edit distance of each candidate to the corpus, at most ``most`` (null beyond that).

    Lossless blocking: a name within distance k of another shares with it one of the k + 1 pieces it is cut into, shifted by
    at most k. Candidates are the bounded side (pieces are broadcast if counted small); each corpus name is scanned once.
    Candidates have more than ``most`` and at most ``max_length`` letters; others get null, and ``novelty`` finds the distance of these too.
    """
    pieces = most + 1
    c = candidates.select("normalized").distinct()

    def cut(i: int):
        start = F.floor(F.length("normalized") * i / pieces).cast("int")
        end = F.floor(F.length("normalized") * (i + 1) / pieces).cast("int")
        return F.struct(F.lit(i).alias("i"), F.length("normalized").alias("n"), start.alias("at"), F.substring("normalized", start + 1, end - start).alias("piece"))

    filed = c.select("normalized", F.explode(F.array(*[cut(i) for i in range(pieces)])).alias("_p")).select("normalized", F.col("_p.at").alias("at"), F.col("_p.piece").alias("piece")).where("piece <> ''").where(F.length("normalized").between(pieces, max_length))
    name, n = F.col("name"), F.length("name")
    grams = corpus.select(F.col("normalized").alias("name")).distinct()
    widths = range(1, -(-max_length // pieces) + 1)
    found = F.explode(F.flatten(F.array(*[
        _pieces(name, n, w) for w in widths
    ]))).alias("_g")
    met = (
        grams.select("name", found).select("name", F.col("_g.pos").alias("pos"), F.col("_g.piece").alias("piece"))
        .join(broadcast_if_small(filed), "piece").where(F.abs(F.col("pos") - F.col("at")) <= most)
        .where(F.abs(F.length("name") - F.length("normalized")) <= most)
        .select("normalized", "name").distinct().withColumn("d", F.levenshtein("normalized", "name", most)).where("d >= 0")
    )
    return c.join(met.groupBy("normalized").agg(F.min("d").alias("min_distance")), "normalized", "left")


def novelty(candidates: DataFrame, corpus: DataFrame) -> DataFrame:
    """(normalized, min_distance): the exact least edit distance of each distinct candidate to the corpus; null only against an empty corpus.

    ``distances_within`` finds those within two; for the rest the bound doubles from round to round over bands of length, until it
    covers the longest name and each has its distance.
    """
    c, grams = candidates.select("normalized").where(F.col("normalized").isNotNull()).distinct(), corpus.select(F.col("normalized").alias("name")).where(F.col("normalized").isNotNull()).distinct()
    longest = lambda df, name: df.agg(F.coalesce(F.max(F.length(name)), F.lit(0))).first()[0]
    bound, most = 4, max(longest(c, "normalized"), longest(grams, "name"))
    known = materialise(distances_within(c, grams.withColumnRenamed("name", "normalized")), "novelty")
    done, rest = known.where(F.col("min_distance").isNotNull()), known.where(F.col("min_distance").isNull()).select("normalized")
    while not rest.isEmpty():
        banded = rest.withColumn("n", F.explode(F.sequence(F.greatest(F.length("normalized") - bound, F.lit(0)), F.length("normalized") + bound)))
        met = grams.withColumn("n", F.length("name")).join(broadcast_if_small(banded), "n").withColumn("d", F.levenshtein("normalized", "name", bound)).where("d >= 0")
        known = materialise(rest.join(met.groupBy("normalized").agg(F.min("d").alias("min_distance")), "normalized", "left"), "novelty")
        if bound >= most:
            return done.unionByName(known)
        done, rest, bound = done.unionByName(known.where(F.col("min_distance").isNotNull())), known.where(F.col("min_distance").isNull()).select("normalized"), bound * 2
    return done


def novelty_distances(candidates: DataFrame, corpus: DataFrame) -> DataFrame:
    """(normalized, edit_distance, phonetic_distance): the least distance of each candidate to all of the corpus, by letters and by sounds.

    The phonetic distance is the edit distance of Double Metaphone codes; null for a name without sounds.
    """
    coded = lambda df: df.select("normalized").where(F.col("normalized").isNotNull()).distinct().withColumn("code", phonetic_key(F.col("normalized")))
    mine = materialise(coded(candidates), "novelty")
    codes = lambda df: df.where("code <> ''").select(F.col("code").alias("normalized")).distinct()
    sounds = novelty(codes(mine), materialise(codes(coded(corpus)), "novelty")).select(F.col("normalized").alias("code"), F.col("min_distance").alias("phonetic_distance"))
    letters = novelty(mine.select("normalized"), corpus).withColumnRenamed("min_distance", "edit_distance")
    return letters.join(mine.join(sounds, "code", "left").select("normalized", "phonetic_distance"), "normalized", "left")


def novelty_summary(distances: DataFrame) -> DataFrame:
    """One row: the number of names, and of both distances the least (for any collision floor) and the 95th percentile."""
    known = materialise(distances, "distances")
    found = known.agg(F.count("*").alias("n_names"), F.min("edit_distance").alias("edit_least"), F.min("phonetic_distance").alias("phonetic_least"))
    for kind in ("edit", "phonetic"):
        found = with_row(found, quantile(known, f"{kind}_distance", 0.95, f"{kind}_p95"))
    return found.select("n_names", "edit_least", "edit_p95", "phonetic_least", "phonetic_p95")


def confusable_skeleton(c):
    """The name as the eye may read it: rn as m, vv as w, and look-alike characters as one."""
    return F.translate(F.replace(F.replace(F.lower(c), F.lit("rn"), F.lit("m")), F.lit("vv"), F.lit("w")), "l1i0", "iiio")


def confusables(names: DataFrame) -> DataFrame:
    """(skeleton, name): the distinct names that share their skeleton with another; classes, not pairs."""
    known = names.select(F.col("normalized").alias("name"), confusable_skeleton(F.col("normalized")).alias("skeleton")).distinct()
    several = known.groupBy("skeleton").agg(F.count("*").alias("_n")).where("_n > 1").select("skeleton")
    return known.join(several, "skeleton").select("skeleton", "name")
