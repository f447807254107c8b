"""Queries of the problems for training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions.text import name_key
from lexloom.llm import format_duplicates, leakage, mixture, reading_level, split_overlap, term_counts
from lexloom.session import table


def _feeds(spark: SparkSession, folder: str):
    """Both tables of names: their rows before and in the last run, and how their rows become deltas."""
    records, delivered = table(spark, folder, "normalised_record").select("norm_id", "normalized"), table(spark, folder, "provider_counts")
    key, last = name_key(F.col("normalized")), delivered.agg(F.max("run_id")).first()[0]
    in_last = F.coalesce(F.col("run_id") == F.lit(last), F.lit(False))
    names = lambda rows, sign: term_counts.change_deltas(rows, scope="normalised_record", sign=sign, term=key, occurrences=F.lit(1))
    runs = lambda rows: term_counts.change_deltas(rows, scope="provider_counts", sign=F.lit(1), term=key, occurrences=F.col("record_count"), distinct=delivered.columns)
    return records, delivered.where(~in_last), delivered.where(in_last), names, runs


def _store(spark: SparkSession, folder: str) -> term_counts.TermCounts:
    """A store of both tables of names, made in three sessions of work: all names, all runs but the last, the last run. Each opens what the one before has left."""
    records, before, last, names, runs = _feeds(spark, folder)
    store = term_counts.TermCounts(spark)
    store.merge(names(records, F.lit(1)))
    for delivery in (before, last):
        store = term_counts.TermCounts(spark, store.path)
        store.merge(runs(delivery))
    return term_counts.TermCounts(spark, store.path)


def _marked(spark: SparkSession, folder: str) -> DataFrame:
    store = _store(spark, folder)
    return term_counts.verdicts(store.counts(), store.totals())


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _marked(spark, folder).where(F.col("verdict").isNotNull()).select(F.col("scope").alias("table_name"), "term", "verdict")


def p2_term_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _marked(spark, folder).select(F.col("scope").alias("table_name"), "term", "occurrences", "records", F.coalesce("verdict", F.lit("useful")).alias("verdict"))


def p2_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The same counts reached through changes of every kind: first a state in which rows are missing, others read differently and others still stand that have gone since."""
    records, before, last, names, runs = _feeds(spark, folder)
    is_new, differs, has_gone = F.col("norm_id") % 5 == 0, (F.col("norm_id") % 7 == 0) & (F.col("norm_id") % 5 != 0), F.col("norm_id") % 11 == 0
    was = records.withColumn("normalized", F.when(differs, F.concat("normalized", F.lit("old"))).otherwise(F.col("normalized")))
    store = term_counts.TermCounts(spark)
    store.merge(names(was.where(~is_new).unionByName(records.where(has_gone)), F.lit(1)).unionByName(runs(before)))
    store = term_counts.TermCounts(spark, store.path)
    feed = [records.where(is_new | differs).withColumn("sign", F.lit(1)), was.where(differs).withColumn("sign", F.lit(-1)), records.where(has_gone).withColumn("sign", F.lit(-1))]
    store.merge(names(feed[0].unionByName(feed[1]).unionByName(feed[2]), F.col("sign")).unionByName(runs(last)))
    return term_counts.TermCounts(spark, store.path).counts().select(F.col("scope").alias("table_name"), "term", "occurrences", "records")


def _duplicates(spark: SparkSession, folder: str) -> list[tuple[str, format_duplicates.FormatDuplicates]]:
    return [
        ("corpus_record", format_duplicates.FormatDuplicates(table(spark, folder, "corpus_record"), "record_id", ["loaded_at"])),
        ("normalised_record", format_duplicates.FormatDuplicates(table(spark, folder, "normalised_record"), "norm_id")),
    ]


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    (a, first), (b, second) = _duplicates(spark, folder)
    named = lambda name, found: found.select(F.lit(name).alias("table_name"), "first_id", "copy_id")
    return named(a, first.members()).unionByName(named(b, second.members()))


def p3_collapsed_names(spark: SparkSession, folder: str) -> DataFrame:
    found = format_duplicates.FormatDuplicates(table(spark, folder, "normalised_record"), "norm_id")
    return found.collapsed().select("norm_id", "normalized", "display", "provider_id", "source_ref", "n_copies")


def p3_collapsed_records(spark: SparkSession, folder: str) -> DataFrame:
    return _duplicates(spark, folder)[0][1].collapsed()


def p3_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Hashes that stand for more than one text, in either table."""
    (a, first), (b, second) = _duplicates(spark, folder)
    return first.collisions().withColumn("table_name", F.lit(a)).unionByName(second.collisions().withColumn("table_name", F.lit(b)))


def _overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return split_overlap.holdout_overlaps(table(spark, folder, "holdout_names"), table(spark, folder, "normalised_record"), table(spark, folder, "corpus_artifact"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _overlaps(spark, folder).select(F.col("eval_id").alias("holdout_id"), "found_in", "found_key")


def p5_per_split(spark: SparkSession, folder: str) -> DataFrame:
    return split_overlap.per_split_and_source(_overlaps(spark, folder), table(spark, folder, "holdout_names"))


def p5_artifact_claims(spark: SparkSession, folder: str) -> DataFrame:
    return split_overlap.artifact_claims(_overlaps(spark, folder), table(spark, folder, "corpus_artifact"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaked(table(spark, folder, "documents"), table(spark, folder, "eval_items")).select("doc_id", "item_id")


def p6_items(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "eval_items")
    return leakage.items_leaked(items, leakage.leaked(table(spark, folder, "documents"), items))


def p6_clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return leakage.without_leaks(documents, leakage.leaked(documents, table(spark, folder, "eval_items"))).select("doc_id", "source", "lang", "n_chars")


#: Output shards of the mixtures and tokens of the blocks that are dealt to them; parameters, alike at every size of the tables.
SHARDS, BLOCK_TOKENS = 64, 1 << 12


def _mixture(spark: SparkSession, folder: str, **more) -> mixture.Mixture:
    return mixture.Mixture(table(spark, folder, "documents"), table(spark, folder, "mix_targets"), n_shards=SHARDS, block_tokens=BLOCK_TOKENS, **more)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    mixed = _mixture(spark, folder)
    return mixture.unreachable(mixed.report(mixed.draws()))


def p7_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return _mixture(spark, folder).draws()


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    mixed = _mixture(spark, folder)
    return mixed.report(mixed.draws())


def _levels(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = reading_level.fit(*reading_level.labelled_sample(documents, table(spark, folder, "reading_labels")))
    return reading_level.reading_levels(documents, model)


def p8_reading_levels(spark: SparkSession, folder: str) -> DataFrame:
    return _levels(spark, folder)


def p8_profile(spark: SparkSession, folder: str) -> DataFrame:
    return reading_level.profile(_levels(spark, folder), table(spark, folder, "documents"))


def p8_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """How often ``p8_reading_levels`` breaks what must hold of every level: never."""
    return reading_level.violations(_levels(spark, folder), table(spark, folder, "documents"))


def p8_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """How well levels meet the labels of the fifth of the labelled documents that the models never saw."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "reading_labels")
    held_out = F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(5)) == 0
    model = reading_level.fit(*reading_level.labelled_sample(documents, labels.where(~held_out)))
    return reading_level.accuracy(reading_level.reading_levels(documents.join(labels.where(held_out).select("doc_id").distinct(), "doc_id", "left_semi"), model), labels)


def p7_exact_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The largest mixture in which every source has its share."""
    mixed = _mixture(spark, folder, exact=True)
    return mixed.report(mixed.draws())


def p7_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """How often ``p7_mixture`` breaks each of the rules of a mixture: never."""
    return _mixture(spark, folder).violations()


def p7_plan_in_words(spark: SparkSession, folder: str) -> DataFrame:
    """Targets and quotas of the mixture with sizes in words, which SQL can count too."""
    return _mixture(spark, folder, sizes=F.size(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)))).plan_frame()


QUERIES = {
    "p2_found": p2_found, "p2_term_counts": p2_term_counts, "p2_incremental": p2_incremental,
    "p3_found": p3_found, "p3_collapsed_names": p3_collapsed_names, "p3_collapsed_records": p3_collapsed_records, "p3_collisions": p3_collisions,
    "p5_found": p5_found, "p5_per_split": p5_per_split, "p5_artifact_claims": p5_artifact_claims,
    "p6_found": p6_found, "p6_items": p6_items, "p6_clean_documents": p6_clean_documents,
    "p7_found": p7_found, "p7_mixture": p7_mixture, "p7_shares": p7_shares, "p7_exact_shares": p7_exact_shares, "p7_invariants": p7_invariants, "p7_plan_in_words": p7_plan_in_words,
    "p8_reading_levels": p8_reading_levels, "p8_profile": p8_profile, "p8_invariants": p8_invariants, "p8_accuracy": p8_accuracy,
}
