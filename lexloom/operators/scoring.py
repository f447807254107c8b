"""Scores as views: nothing composite is stored, subscores stay beside it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.session import materialise, with_row

#: Postures that are compared with each vector at a time.
MAX_POSTURES = 1_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; null where either has no length."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def centroids(vectors: DataFrame, label: str, embedding: str) -> DataFrame:
    """(label, centroid): the mean vector per label, by exploding dimensions so that means are combined map-side."""
    by_dim = vectors.select(label, F.posexplode(embedding).alias("dim", "v")).groupBy(label, "dim").agg(F.avg(F.col("v").cast("double")).alias("m"))
    return by_dim.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda x: x["m"]).alias("centroid"))


def posture_fit(vectors: DataFrame, postures: DataFrame, embedding: str = "embedding", posture: str = "posture", vector: str = "centroid") -> DataFrame:
    """Cosine of each vector with each posture: a stated set of queries against all rows, in blocks of about ``MAX_POSTURES``.

    The postures of a block are held as one array (a scalar subquery), so a block reads each vector once and nothing is joined.
    """
    postures = materialise(postures.select(F.col(posture).alias("posture"), F.col(vector).alias("c")), "postures")
    n_blocks, found = -(-postures.count() // MAX_POSTURES) or 1, None
    for block in range(n_blocks):
        queries = postures.where(F.pmod(F.xxhash64("posture"), F.lit(n_blocks)) == block).agg(F.collect_list(F.struct("posture", "c")).alias("_queries"))
        met = with_row(vectors, queries).select(*vectors.columns, F.explode("_queries").alias("_q"))
        part = met.select(*vectors.columns, F.col("_q.posture").alias("posture"), cosine(F.col(embedding), F.col("_q.c")).alias("fit"))
        found = part if found is None else found.unionByName(part)
    return found


def composite(scores: DataFrame, weights: Mapping[str, float], name: str = "composite") -> DataFrame:
    """``scores`` with a weighted mean of its subscores; a null subscore leaves its weight out."""
    parts = [(F.col(c), w) for c, w in weights.items()]
    top = sum((F.coalesce(c, F.lit(0.0)) * w for c, w in parts), F.lit(0.0))
    bottom = sum((F.when(c.isNotNull(), w).otherwise(0.0) for c, w in parts), F.lit(0.0))
    return scores.withColumn(name, F.try_divide(top, bottom))


def explain(scores: DataFrame, key: Sequence[str], weights: Mapping[str, float], origins: Mapping[str, tuple[str, str, str]], name: str = "composite") -> DataFrame:
    """(key, number, value, weight, part, layer, writer, version): a row per number, those that make up a composite with their weight and part of it.

    ``origins`` has layer, writer and version of every number; one that isn't named there is refused.
    """
    unknown = sorted({*weights, name} - set(origins))
    if unknown:
        raise ValueError(f"no origin is known of {', '.join(unknown)}")
    total = sum((F.when(F.col(c).isNotNull(), w).otherwise(0.0) for c, w in weights.items()), F.lit(0.0))
    made = composite(scores, weights, name)
    row = lambda c, w: F.struct(F.lit(c).alias("number"), F.col(c).cast("double").alias("value"), F.lit(w).cast("double").alias("weight"), F.try_divide(F.col(c) * w, total).cast("double").alias("part") if w is not None else F.lit(None).cast("double").alias("part"), *[F.lit(x).alias(k) for k, x in zip(("layer", "writer", "version"), origins[c], strict=True)])
    return made.select(*key, F.explode(F.array(row(name, None), *[row(c, w) for c, w in weights.items()])).alias("_r")).select(*key, "_r.*")


def composite_view(scores: DataFrame, weights: Mapping[str, float], view: str) -> None:
    """Register the composite as a temporary view: computed where it is read, never stored."""
    composite(scores, weights).createOrReplaceTempView(view)


def market_basket(scores: DataFrame, item: str, score: str, weight: str, floor: float) -> DataFrame:
    """(item, basket_score, lowest): weighted mean over markets; null where any market is below the floor."""
    found = scores.groupBy(item).agg(F.sum(F.col(weight) * F.col(score)).alias("_s"), F.sum(weight).alias("_w"), F.min(score).alias("lowest"))
    return found.select(item, F.when(F.col("lowest") >= floor, F.try_divide("_s", "_w")).alias("basket_score"), "lowest")


def denotation(parts: DataFrame) -> DataFrame:
    """(item, concept, weight): head-weighted union of concepts, each at its greatest weight over parts (item, concept, weight, is_head)."""
    return parts.groupBy("item", "concept").agg(F.max(F.col("weight") * F.when(F.col("is_head"), 1.0).otherwise(0.5)).alias("weight"))


def connotation(parts: DataFrame, shifts: DataFrame | None = None) -> DataFrame:
    """(item, dimension, value): salience-weighted mean over parts (item, dimension, value, salience), then an additive shift per item and dimension."""
    mean = parts.groupBy("item", "dimension").agg(F.try_divide(F.sum(F.col("value") * F.col("salience")), F.sum("salience")).alias("value"))
    if shifts is None:
        return mean
    return mean.join(shifts.groupBy("item", "dimension").agg(F.sum("shift").alias("shift")), ["item", "dimension"], "left").select(
        "item", "dimension", (F.col("value") + F.coalesce("shift", F.lit(0.0))).alias("value")
    )


def domain_fit(parts: DataFrame) -> DataFrame:
    """(item, domain, value): the greatest weighted value."""
    return parts.groupBy("item", "domain").agg(F.max(F.col("weight") * F.col("value")).alias("value"))


def tag_overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of tags; 0 of nothing."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def retrieve(names: DataFrame, brief_tags: Sequence[str], brief_vector: Column | None = None, limit: int = 15) -> DataFrame:
    """The best names by shared tags, then by vector: only names that share a tag are scored; never by their spelling."""
    wanted = F.array(*[F.lit(t) for t in brief_tags])
    met = names.where(F.arrays_overlap("tags", wanted)).withColumn("overlap", tag_overlap(F.col("tags"), wanted))
    score = F.col("overlap") if brief_vector is None else F.col("overlap") + cosine(F.col("embedding"), brief_vector)
    return met.withColumn("score", score).orderBy(F.desc("score"), "normalized").limit(limit)


def length_curve(n: Column, low: int, best_low: int, best_high: int, high: int) -> Column:
    """1 within the best lengths, falling in a line to 0 at the ends."""
    return (
        F.when(n.between(best_low, best_high), 1.0).when((n <= low) | (n >= high), 0.0)
        .when(n < best_low, (n - low) / (best_low - low)).otherwise((high - n) / (high - best_high))
    )


def memorability(name: Column) -> Column:
    """Share of three signs: a repeated first letter, a doubled letter pair, at most eight letters."""
    first = F.substring(name, 1, 1)
    signs = [F.substring(name, 2, 99).contains(first), name.rlike(r"(..).*\1"), F.length(name) <= 8]
    return sum((s.cast("int") for s in signs), F.lit(0)) / 3


def strength_class(coined: Column, word: Column, suggestive: Column, descriptive: Column) -> Column:
    """fanciful, arbitrary, suggestive, descriptive or generic, from flags of lexicons."""
    return F.when(coined, "fanciful").when(descriptive & word, "generic").when(descriptive, "descriptive").when(suggestive, "suggestive").otherwise("arbitrary")


def spelling_ambiguity(variants: DataFrame) -> DataFrame:
    """(phonoform_id, n_variants, spellability): how many spellings sound alike."""
    return variants.groupBy("phonoform_id").agg(F.count_distinct("surface").alias("n_variants")).withColumn("spellability", F.lit(1.0) / F.col("n_variants"))


def by_scope(names: DataFrame, phonoform: DataFrame, surface: DataFrame, derivation: DataFrame) -> DataFrame:
    """Phenotype of three scopes joined late: scores are computed once per sound, spelling and derivation, never per row.

    ``names`` has name_id, phonoform_id, surface, derivation_id; the scores are keyed by these.
    """
    return names.join(phonoform, "phonoform_id", "left").join(surface, "surface", "left").join(derivation, "derivation_id", "left")


def forced_choice(answers: DataFrame) -> DataFrame:
    """(arm, n_answers, accuracy, p_value): share of right choices between two, and how likely as many are by chance (normal approximation, two-sided)."""
    found = answers.groupBy("arm").agg(F.count("*").alias("n_answers"), F.avg(F.col("is_right").cast("double")).alias("accuracy"))
    z = F.abs(F.col("accuracy") - 0.5) / F.sqrt(F.lit(0.25) / F.col("n_answers"))
    # Abramowitz and Stegun 7.1.26 for the error function.
    t = 1 / (1 + 0.3275911 * z / F.sqrt(F.lit(2.0)))
    erf = 1 - t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-z * z / 2)
    return found.withColumn("p_value", 1 - erf)
