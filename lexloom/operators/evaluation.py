"""Measures of a set of names: typicality under n-gram models, entropy, distinct n-grams, concentration, overlap, agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.operators.ordering import quantile, running_total
from lexloom.session import broadcast_if_small, materialise, with_row


def char_grams(name: Column, n: int) -> Column:
    """The n-grams of a name framed by n - 1 starts and one end."""
    framed = F.concat(F.lit("^" * (n - 1)), name, F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(name) + 1), lambda i: F.substring(framed, i, F.lit(n)))


def _counts(names: DataFrame, n: int) -> DataFrame:
    return names.select(F.explode(char_grams(F.col("normalized"), n)).alias("gram")).groupBy("gram").agg(F.count("*").alias("c"))


def typicality(names: DataFrame, training: DataFrame, n: int = 2, add: float = 1.0) -> DataFrame:
    """(normalized, mean_log_prob): mean log-probability of a name's characters under an add-k n-gram model of ``training``.

    The model has a row per n-gram of an alphabet, so it is broadcast behind a count; unseen n-grams take the smoothed
    share of their context, unseen contexts a uniform one over the 27 possible next characters.
    """
    grams = _counts(training, n)
    model = grams.withColumn("context", F.substring("gram", 1, n - 1))
    totals = model.groupBy("context").agg(F.sum("c").alias("t"))
    scored = (
        names.select("normalized").distinct().select("normalized", F.explode(char_grams(F.col("normalized"), n)).alias("gram")).withColumn("context", F.substring("gram", 1, n - 1))
        .join(broadcast_if_small(grams), "gram", "left").join(broadcast_if_small(totals), "context", "left")
    )
    p = (F.coalesce("c", F.lit(0)) + F.lit(add)) / (F.coalesce("t", F.lit(0)) + F.lit(27 * add))
    return scored.groupBy("normalized").agg(F.avg(F.log(p)).alias("mean_log_prob"))


def kneser_ney_counts(training: DataFrame, n: int) -> DataFrame:
    """(k, gram, c, context): counts of the n-grams, and of each lower order k in how many continuations a gram stands.

    The n-grams are counted once and written; a gram of order k is the end of as many different (k + 1)-grams as it counts, and
    these are the ends of the distinct n-grams, so all lower orders come from one pass over them.
    """
    top = materialise(_counts(training, n), "ngrams")
    ends = top.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.substring("gram", n - k, k + 1).alias("longer")) for k in range(1, n)])).alias("e")).select("e.*").distinct()
    lower = ends.groupBy("k", F.expr("substring(longer, 2)").alias("gram")).agg(F.count("*").alias("c"))
    return top.select(F.lit(n).alias("k"), "gram", "c").unionByName(lower).withColumn("context", F.expr("substring(gram, 1, k - 1)"))


def kneser_ney(names: DataFrame, training: DataFrame, n: int = 5, discount: float = 0.75) -> DataFrame:
    """(normalized, mean_log_prob, z): interpolated Kneser-Ney of order ``n``, z against all scored names.

    One table holds the counts of all orders, one those of their contexts; a name's places meet both once, order by order in
    rows. The tables are bounded by the n-grams of the alphabet and broadcast only behind a check of their size.
    """
    table = materialise(kneser_ney_counts(training, n), "orders")
    contexts = materialise(table.groupBy("k", "context").agg(F.sum("c").alias("t"), F.count("*").alias("f")), "contexts")
    places = names.select("normalized").distinct().select("normalized", F.posexplode(char_grams(F.col("normalized"), n)).alias("pos", "full"))
    orders = F.array(*[F.struct(F.lit(k).alias("k"), F.substring("full", n - k + 1, k).alias("gram"), F.substring("full", n - k + 1, k - 1).alias("context")) for k in range(1, n + 1)])
    met = places.select("normalized", "pos", F.explode(orders).alias("o")).select("normalized", "pos", "o.*")
    met = met.join(broadcast_if_small(table.select("k", "gram", "c")), ["k", "gram"], "left").join(broadcast_if_small(contexts), ["k", "context"], "left")
    of = lambda k, c: F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}")
    scored = met.groupBy("normalized", "pos").agg(*[of(k, c) for k in range(1, n + 1) for c in "ctf"])
    prob: Column = F.lit(1 / 27)
    for k in range(1, n + 1):
        seen = F.greatest(F.coalesce(f"c{k}", F.lit(0)) - F.lit(discount), F.lit(0.0))
        prob = F.when(F.col(f"t{k}").isNull(), prob).otherwise((seen + F.lit(discount) * F.col(f"f{k}") * prob) / F.col(f"t{k}"))
    per_name = scored.groupBy("normalized").agg(F.avg(F.log(prob)).alias("mean_log_prob"))
    spread = per_name.agg(F.avg("mean_log_prob").alias("_m"), F.stddev_samp("mean_log_prob").alias("_s"))
    return with_row(per_name, spread).select("normalized", "mean_log_prob", F.try_divide(F.col("mean_log_prob") - F.col("_m"), F.col("_s")).alias("z"))


def histogram_overlap(a: DataFrame, b: DataFrame, value: str, width: float) -> DataFrame:
    """One row: the sum over bins of the smaller of the two shares."""
    bins = lambda df, name: df.groupBy(F.floor(F.col(value) / width).alias("bin")).agg(F.count("*").alias(name))
    both = bins(a, "na").join(bins(b, "nb"), "bin", "full")
    total = both.agg(F.sum("na").alias("ta"), F.sum("nb").alias("tb"))
    share = F.least(F.coalesce("na", F.lit(0)) / F.col("ta"), F.coalesce("nb", F.lit(0)) / F.col("tb"))
    return with_row(both, total).agg(F.sum(share).alias("overlap"))


def distinct_n(names: DataFrame, n: int) -> DataFrame:
    """One row: distinct over all n-grams within the names."""
    inner = F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.length("normalized") - n + 1, F.lit(1))), lambda i: F.substring("normalized", i, F.lit(n))), lambda g: F.length(g) == n)
    by_gram = names.select(F.explode(inner).alias("gram")).groupBy("gram").agg(F.count("*").alias("c"))
    return by_gram.agg(F.count("*").alias("n_distinct"), F.sum("c").alias("n_grams")).withColumn("distinct_share", F.coalesce(F.try_divide("n_distinct", "n_grams"), F.lit(0.0)))


def entropy(parts: DataFrame, group: str, value: str) -> DataFrame:
    """(group, entropy in bits) of a value's distribution per group."""
    by_value = parts.groupBy(group, value).agg(F.count("*").alias("c"))
    total = by_value.groupBy(group).agg(F.sum("c").alias("t"), F.sum(F.col("c") * F.log2("c")).alias("s"))
    return total.select(group, (F.log2("t") - F.col("s") / F.col("t")).alias("entropy_bits"))


def syllable_parts(names: DataFrame) -> DataFrame:
    """(part, value): the onset, first nucleus and coda of each name's letters."""
    onset, nucleus, coda = (F.regexp_extract("normalized", p, 1) for p in ("^([^aeiouy]*)", "^[^aeiouy]*([aeiouy]+)", "([^aeiouy]*)$"))
    return names.select(F.explode(F.array(*[F.struct(F.lit(k).alias("part"), v.alias("value")) for k, v in (("onset", onset), ("nucleus", nucleus), ("coda", coda))])).alias("p")).select("p.*")


def template_distribution(names: DataFrame, vowels: str = "aeiouy") -> DataFrame:
    """(template, n_names, share): how many names have each pattern of consonants (C) and vowels (V), runs as one letter each."""
    shape = F.regexp_replace(F.regexp_replace("normalized", f"[^{vowels}]+", "C"), f"[{vowels}]+", "V")
    by_shape = names.groupBy(shape.alias("template")).agg(F.count("*").alias("n_names"))
    return with_row(by_shape, by_shape.agg(F.sum("n_names").alias("_all"))).select("template", "n_names", (F.col("n_names") / F.col("_all")).alias("share"))


def at_least_as_typical(scores: DataFrame, value: str, share: float) -> DataFrame:
    """One row: the quantile above which the best ``share`` of scores lies, and how many reach it."""
    marked = with_row(scores, quantile(scores, value, 1 - share, "_limit"))
    return marked.agg(F.max("_limit").alias("threshold"), F.count_if(F.col(value) >= F.col("_limit")).alias("n_above"), F.count("*").alias("n_names"))


def gini(usage: DataFrame, value: str) -> DataFrame:
    """One row: the Gini coefficient of a non-negative count; 0 of nothing.

    Values are grouped first; the running count over the distinct ones is split by ranges.
    """
    by_value = usage.groupBy(F.col(value).cast("double").alias("x")).agg(F.count("*").alias("m"))
    ranked = running_total(by_value, "x", F.col("m"), "before").withColumn("rank_sum", F.col("m") * F.col("before") + F.col("m") * (F.col("m") + 1) / 2)
    sums = ranked.agg(F.sum("m").alias("n"), F.sum(F.col("x") * F.col("m")).alias("total"), F.sum(F.col("x") * F.col("rank_sum")).alias("weighted"))
    return sums.select(F.coalesce(F.try_divide(2 * F.col("weighted"), F.col("n") * F.col("total")) - (F.col("n") + 1) / F.col("n"), F.lit(0.0)).alias("gini"))


def gate_yield(flags: DataFrame, gates: list[str]) -> DataFrame:
    """(gate, position, n_in, n_out): names that reach and pass each gate, in order."""
    alive, counts = F.lit(True), []
    for g in gates:
        counts += [F.count_if(alive).alias(f"in_{g}"), F.count_if(alive & F.col(g)).alias(f"out_{g}")]
        alive = alive & F.col(g)
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(g).alias("gate"), F.col(f"in_{g}").alias("n_in"), F.col(f"out_{g}").alias("n_out")) for i, g in enumerate(gates)])
    return flags.agg(*counts).select(F.explode(rows).alias("r")).select("r.*")


def frontier(scores: DataFrame, arm: str, x: str, y: str) -> DataFrame:
    """Per arm the names in each quadrant around the medians of all."""
    at = with_row(with_row(scores, quantile(scores, x, 0.5, "mx")), quantile(scores, y, 0.5, "my"))
    high_x, high_y = F.col(x) >= F.col("mx"), F.col(y) >= F.col("my")
    return at.groupBy(arm).agg(F.count_if(high_x & high_y).alias("both"), F.count_if(high_x & ~high_y).alias("only_x"), F.count_if(~high_x & high_y).alias("only_y"), F.count_if(~high_x & ~high_y).alias("neither"))


def average_ranks(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with the rank of a value, ties sharing their mean rank; the running count is split by ranges."""
    by_value = running_total(df.groupBy(value).agg(F.count("*").alias("_m")), value, F.col("_m"), "_before")
    return df.join(by_value.select(value, (F.col("_before") + (F.col("_m") + 1) / 2).alias(name)), value)


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: the rank correlation of two columns."""
    return average_ranks(average_ranks(df.select(a, b), a, "_ra"), b, "_rb").agg(F.corr("_ra", "_rb").alias("spearman"))


def krippendorff_alpha(ratings: DataFrame, unit: str, value: str) -> DataFrame:
    """One row: Krippendorff's alpha for interval data, from per-unit and total sums; null where nothing can be paired."""
    v = F.col(value).cast("double")
    units = ratings.where(F.col(value).isNotNull()).groupBy(unit).agg(F.count("*").alias("m"), F.sum(v).alias("s"), F.sum(v * v).alias("q")).where("m > 1")
    within = F.sum(2 * (F.col("m") * F.col("q") - F.col("s") * F.col("s")) / (F.col("m") - 1))
    sums = units.agg(within.alias("w"), F.sum("m").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    observed = F.try_divide("w", "n")
    expected = F.try_divide(2 * (F.col("n") * F.col("q") - F.col("s") * F.col("s")), F.col("n") * (F.col("n") - 1))
    return sums.select((1 - F.try_divide(observed, expected)).alias("alpha"))
