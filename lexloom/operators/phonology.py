"""Constraints on built names, over arrays of phonemes; all parameters come with a language pack, none is built in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.session import broadcast_if_small


@dataclass(frozen=True)
class LanguagePack:
    """A language as data: sonority ranks, vowels, longest cluster, safe phonemes."""

    pack_id: str
    sonority: Mapping[str, int]
    vowels: frozenset[str]
    longest_cluster: int = 2
    safe: frozenset[str] = frozenset()


#: A pack that is no language: it shows that the operators know of none.
TOY = LanguagePack("toy", {"p": 1, "t": 1, "k": 1, "s": 2, "m": 3, "n": 3, "l": 4, "r": 4, "a": 5, "i": 5, "u": 5}, frozenset("aiu"), 2, frozenset("ptkmnaiu"))


def _rank(pack: LanguagePack, phoneme: Column) -> Column:
    table = F.create_map(*[F.lit(x) for p, r in sorted(pack.sonority.items()) for x in (p, r)])
    return F.try_element_at(table, phoneme)


def sonority_rises(onset: Column, pack: LanguagePack) -> Column:
    """Whether the sonority of an onset's phonemes rises strictly towards the nucleus."""
    ranks = F.transform(onset, lambda p: _rank(pack, p))
    return F.forall(F.sequence(F.lit(1), F.greatest(F.size(onset), F.lit(1))), lambda i: (i >= F.size(onset)) | (F.get(ranks, i - 1) < F.get(ranks, i)))


def no_repeat(phonemes: Column) -> Column:
    """Whether no two neighbours are the same phoneme."""
    return ~F.exists(F.zip_with(phonemes, F.slice(phonemes, F.lit(2), F.greatest(F.size(phonemes), F.lit(1))), lambda a, b: a == b), lambda x: F.coalesce(x, F.lit(False)))


def clusters_within(phonemes: Column, pack: LanguagePack) -> Column:
    """Whether no run of consonants is longer than the pack allows."""
    shape = F.array_join(F.transform(phonemes, lambda p: F.when(p.isin(*sorted(pack.vowels)), "V").otherwise("C")), "")
    return ~shape.contains("C" * (pack.longest_cluster + 1))


def no_hiatus(phonemes: Column, pack: LanguagePack) -> Column:
    shape = F.array_join(F.transform(phonemes, lambda p: F.when(p.isin(*sorted(pack.vowels)), "V").otherwise("C")), "")
    return ~shape.contains("VV")


def globally_safe(phonemes: Column, pack: LanguagePack) -> Column:
    return F.forall(phonemes, lambda p: p.isin(*sorted(pack.safe)))


def degeminated(surface: Column) -> Column:
    """Doubled letters made single."""
    return F.regexp_replace(surface, r"(.)\1+", "$1")


def gates(names: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """``names`` with ``failed_gate``: the first gate that fails, null for what passes all. Nothing is deleted."""
    chain = F
    for name, passes in checks:
        chain = chain.when(~passes, name)
    return names.withColumn("failed_gate", chain)


def top_variants(variants: DataFrame, k: int = 8) -> DataFrame:
    """The ``k`` best spellings of each phonoform: by fidelity, frequency, register, spelling; cut before the shuffle."""
    order = Window.partitionBy("phonoform_id").orderBy(F.desc("fidelity"), F.desc("frequency"), "register", "surface")
    return variants.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def round_trip(phonemes: Column, again: Column) -> Column:
    """Alignment of phonemes with those read back from the spelling: 1 less distance over length."""
    a, b = F.array_join(phonemes, ""), F.array_join(again, "")
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def available_variants(variants: DataFrame, taken: DataFrame) -> DataFrame:
    """(phonoform_id, surface, is_taken) for the sounds of which one spelling is taken and another free; members, not pairs."""
    marked = variants.select("phonoform_id", F.col("surface").alias("normalized")).join(taken.select("normalized").distinct().withColumn("_t", F.lit(True)), "normalized", "left")
    marked = marked.withColumn("is_taken", F.coalesce("_t", F.lit(False)))
    both = marked.groupBy("phonoform_id").agg(F.bool_or("is_taken").alias("_some"), F.bool_and("is_taken").alias("_all")).where("_some and not _all")
    return marked.join(both, "phonoform_id", "left_semi").select("phonoform_id", F.col("normalized").alias("surface"), "is_taken")


def compose(left: DataFrame, right: DataFrame, links: DataFrame) -> DataFrame:
    """(left_id, right_id, surface): morphemes joined where a rule (left_type, right_type, linking_vowel) lets them; a vowel is left out beside another."""
    met = left.select(F.col("id").alias("left_id"), F.col("form").alias("lf"), F.col("type").alias("left_type")).join(broadcast_if_small(links), "left_type").join(
        right.select(F.col("id").alias("right_id"), F.col("form").alias("rf"), F.col("type").alias("right_type")), "right_type"
    )
    bridge = F.when(F.col("lf").rlike("[aeiouy]$") | F.col("rf").rlike("^[aeiouy]"), "").otherwise(F.coalesce("linking_vowel", F.lit("")))
    return met.select("left_id", "right_id", degeminated(F.concat("lf", bridge, "rf")).alias("surface"))


def saturation_weight(morphemes: DataFrame, usage: DataFrame) -> DataFrame:
    """(id, weight) lowered by how many names already use the morpheme: weight / (1 + log(1 + brand_count))."""
    counts = usage.groupBy("id").agg(F.sum("brand_count").alias("_n"))
    return morphemes.join(counts, "id", "left").select("id", (F.col("weight") / (1 + F.log1p(F.coalesce("_n", F.lit(0))))).alias("weight"))


def mutations(c: Column) -> Column:
    """Lexical mutations of a word as an array: vowels moved on, last vowel dropped, first and second half swapped."""
    shifted = F.translate(c, "aeiou", "eioua")
    cut = F.regexp_replace(c, r"[aeiouy]([^aeiouy]*)$", "$1")
    half = F.floor(F.length(c) / 2).cast("int")
    return F.array_distinct(F.array(shifted, cut, F.concat(F.substring(c, half + 1, F.length(c)), F.substring(c, F.lit(1), half))))


def portmanteau(a: Column, b: Column) -> Column:
    """The first half of one word and the second of another."""
    ha, hb = F.ceil(F.length(a) / 2).cast("int"), F.floor(F.length(b) / 2).cast("int")
    return F.concat(F.substring(a, F.lit(1), ha), F.substring(b, hb + 1, F.length(b)))
