"""The catalogue of queries over whole tables, one per operator or group of operators, and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators import addressing, aggregate, artifact, evaluation, facts, holdout, inventory, ledger, licensing, normalise, phonology, scoring, screening
from lexloom.session import broadcast_if_small, scratch_path, table
from lexloom.streaming import facts as streams
from lexloom.types import BlendEntry, CorpusBlend, LicenceClass, ProviderDescriptor, ProviderKind, Use

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: What the providers of the test tables are, by the first part of their id (values of these queries, not of the engine).
PREFIXES = {
    "appdir": ("usage", "tos_restricted"), "domlist": ("usage", "open_attribution"), "marq": ("registry", "public_domain"), "namepool": ("internal", "internal_generated"),
    "packidx": ("usage", "open_attribution"), "regio": ("registry", "open_attribution"), "startlog": ("curated", "commercial_licensed"),
    "tradebk": ("curated", "unknown"), "uspto": ("registry", "public_domain"),
}
_PROVIDERS_SQL = "providers(prefix, kind, licence) as (values " + ", ".join(f"('{p}', '{k}', '{c}')" for p, (k, c) in PREFIXES.items()) + ")"
_USES = {str(c): sorted(map(str, uses)) for c, uses in licensing.PERMITTED_USES.items()}
_MATRIX_SQL = "matrix(licence, use_kind) as (values " + ", ".join(f"('{c}', '{u}')" for c, uses in _USES.items() for u in uses) + ")"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def kept(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return kept


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "corpus_record")


def _accepted(spark: SparkSession, folder: str) -> DataFrame:
    return normalise.normalise(_records(spark, folder))


def _held(spark: SparkSession, folder: str) -> DataFrame:
    return holdout.canonical(table(spark, folder, "holdout_names"), "name_line")


def _providers(spark: SparkSession, folder: str) -> DataFrame:
    ids = _records(spark, folder).select("provider_id").distinct()
    known = spark.createDataFrame([(p, k, c) for p, (k, c) in PREFIXES.items()], "prefix string, kind string, licence string")
    return ids.withColumn("prefix", F.substring_index("provider_id", ".", 1)).join(F.broadcast(known), "prefix").select("provider_id", "kind", "licence")


def _facts(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.select(
        F.col("user_id").alias("candidate_id"), F.col("event_type").alias("source"), F.when(F.col("event_type").isin("purchase", "signup"), "registered").otherwise("free").alias("status"),
        F.col("value").alias("confidence"), F.col("ts").alias("checked_at"), (F.col("ts") + F.expr("interval 30 days")).alias("expires_at"),
    )


_WS = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x0b]"
_STATUS = f"case when lower(regexp_replace(status, '^{_WS}+|{_WS}+$', '', 'g')) in ('live', 'dead') then lower(regexp_replace(status, '^{_WS}+|{_WS}+$', '', 'g')) else 'unknown' end"
_LEGAL = ", ".join(f"'{t}'" for t in normalise.LEGAL_ENTITY_TOKENS)
_BASE = f"""
raw_ as (select record_id, provider_id, source_ref, {_STATUS} as status, first_seen_year, categories, source_fields,
  regexp_replace(coalesce(text, ''), '^{_WS}+|{_WS}+$', '', 'g') as display from corpus_record),
known as (select *, lower(display) as normalized, case
  when display = '' then 'empty_text' when regexp_matches(display, '{_WS}') then 'multi_token' when not regexp_full_match(display, '[A-Za-z]+') then 'non_alphabetic'
  when length(display) < 3 then 'too_short' when length(display) > 16 then 'too_long' when lower(display) in ({_LEGAL}) then 'legal_entity_artifact' end as rule from raw_),
accepted as (select * from known where rule is null),
held as (select distinct lower(n) as normalized from (select regexp_replace(name_line, '^{_WS}+|{_WS}+$', '', 'g') as n from holdout_names) where regexp_full_match(n, '[A-Za-z]+')),
saturation as (select normalized, provider_id, count(*) as record_count, count(*) filter (status = 'live') as live, count(*) filter (status = 'dead') as dead,
  min(first_seen_year) as earliest_year, max(first_seen_year) as latest_year from accepted group by 1, 2),
totals as (select normalized, count(*) as convergent_provider_count, sum(record_count)::bigint as total_count, min(earliest_year) as earliest_year from saturation group by 1)
"""


@query(f"with {_BASE} select record_id, normalized, display, provider_id, status from accepted")
def normalise_accepted(spark, folder):
    return _accepted(spark, folder).select("record_id", "normalized", "display", "provider_id", "status")


@query(f"with {_BASE} select rule, case when display = '' then '<empty>' else display end as detail, provider_id, source_ref from known where rule is not null")
def normalise_rejections(spark, folder):
    return normalise.rejections(_records(spark, folder))


@query(f"""with {_BASE}, f as (select provider_id, count(*) as extracted, count(*) filter (rule is null) as accepted, count(distinct normalized) filter (rule is null) as distinct_names,
  {', '.join(f"count(*) filter (rule = '{r}') as {r}" for r in ('empty_text', 'multi_token', 'non_alphabetic', 'too_short', 'too_long', 'legal_entity_artifact'))} from known group by 1)
  select *, extracted - accepted as rejected_total, round(accepted / extracted, 9) as acceptance_rate from f""")
def funnel_by_provider(spark, folder):
    return normalise.funnel(_records(spark, folder)).withColumn("acceptance_rate", F.round("acceptance_rate", 9))


@query(f"with {_BASE} select rule, count(*) as n_rejected from known where rule is not null group by 1")
def rejection_histogram(spark, folder):
    return normalise.rejection_histogram(_records(spark, folder))


@query(f"""with {_BASE} select case when grouping(provider_id) = 1 then 'all' else provider_id end as provider_id, case when grouping(outcome) = 1 then 'all' else outcome end as outcome, count(*) as n_rows
  from (select provider_id, coalesce(rule, 'accepted') as outcome from known) group by rollup (provider_id, outcome)""")
def funnel_rollup(spark, folder):
    return normalise.funnel_rollup(_records(spark, folder))


@query(f"""with {_BASE} select normalized, bool_or(status = 'dead') as abandoned, bool_or(normalized in (select lower(normalized) from provider_counts where normalized is not null)) as dictionary_word,
  bool_or(coalesce(source_fields['international_registration'] <> '', false)) as international_registration, bool_or(status = 'live') as live_registration,
  bool_or(not regexp_matches(normalized, '[aeiouy]')) as probable_acronym, bool_or(normalized in (select normalized from held)) as profanity_signal from accepted group by 1""")
def tag_flags(spark, folder):
    tagged = normalise.normalise(_records(spark, folder), table(spark, folder, "provider_counts").select("normalized"), _held(spark, folder))
    return aggregate.name_flags(tagged)


@query(f"""with {_BASE} select record_id, case when rule is null and status = 'live' and coalesce(source_fields['drawing_code'] in ('4', '5'), false) and length(normalized) between 4 and 14
  and normalized not in (select normalized from held) and regexp_matches(normalized, '[aeiouy]') then 'A' when rule is null then 'B' when rule = 'multi_token' then 'C' end as tier from known""")
def tier_assignment(spark, folder):
    return normalise.tiers(_records(spark, folder), _held(spark, folder)).select("record_id", "tier")


@query(f"with {_BASE} select distinct normalized from accepted where normalized like '%or%' and normalized not like '%x%' and length(normalized) between 5 and 9")
def brief_filter(spark, folder):
    return normalise.brief_filter(_accepted(spark, folder).select("normalized").distinct(), must_include="or", must_avoid=["x"], length=(5, 9))


@query("""select case when not coalesce(source_fields['drawing_code'] in ('4', '5'), true) then 'drawing_code' else 'blank_text' end as reason, count(*) as n_rows from corpus_record
  where not coalesce(source_fields['drawing_code'] in ('4', '5'), true) or trim(coalesce(text, '')) = '' group by 1""")
def source_filtered(spark, folder):
    from lexloom.sources.registry_csv import source_filtered as counted

    return counted(_records(spark, folder).withColumn("text", F.coalesce("text", F.lit(""))).withColumn(
        "source_fields", F.create_map(F.lit("drawing_code"), F.try_element_at("source_fields", F.lit("drawing_code")))
    ))


@query(f"with {_BASE} select * from saturation")
def saturation_by_provider(spark, folder):
    return aggregate.saturation(_accepted(spark, folder))


@query(f"with {_BASE} select * from totals")
def saturation_total(spark, folder):
    return aggregate.convergence(aggregate.saturation(_accepted(spark, folder)))


@query(f"with {_BASE} select normalized, arg_min(display, record_id) as display from accepted group by 1")
def first_display(spark, folder):
    return aggregate.first_display(_accepted(spark, folder), "record_id")


@query(f"with {_BASE} select normalized, string_agg(c, ',' order by c) as categories from (select distinct normalized, unnest(categories) as c from accepted) where c is not null group by 1")
def category_union(spark, folder):
    return aggregate.category_union(_accepted(spark, folder))


@query(f"with {_BASE} select normalized, c as category, count(*) as n_records from (select normalized, unnest(categories) as c from accepted) where c is not null group by 1, 2")
def category_histogram(spark, folder):
    return aggregate.name_categories(_accepted(spark, folder))


@query("""select normalized, provider_id, sum(coalesce(record_count, 0))::bigint as record_count, sum(coalesce(live, 0))::bigint as live, sum(coalesce(dead, 0))::bigint as dead, min(earliest_year) as earliest_year
  from (select distinct * from provider_counts) group by 1, 2""")
def saturation_from_runs(spark, folder):
    return aggregate.from_counts(table(spark, folder, "provider_counts").select("run_id", "normalized", "provider_id", "record_count", "live", "dead", "earliest_year"))


@query(f"with {_BASE} select normalized, total_count, round(percent_rank() over (order by total_count), 9) as percentile from totals")
def saturation_percentile(spark, folder):
    totals = aggregate.convergence(aggregate.saturation(_accepted(spark, folder)))
    return aggregate.saturation_percentile(totals).withColumn("percentile", F.round("percentile", 9))


@query(f"""with {_BASE}, v as (select distinct normalized, regexp_replace(normalized, '[aeiouy]', '', 'g') as p, normalized in (select normalized from held) as t from accepted)
  select p as phonoform_id, normalized as surface, t as is_taken from v where p in (select p from v group by 1 having bool_or(t) and not bool_and(t))""")
def available_variants(spark, folder):
    variants = _accepted(spark, folder).select(F.regexp_replace("normalized", "[aeiouy]", "").alias("phonoform_id"), F.col("normalized").alias("surface")).distinct()
    return phonology.available_variants(variants, _held(spark, folder))


@query("select source_ref, count(*) as n_rows from normalised_record group by 1 having count(*) > 1")
def duplicate_refs(spark, folder):
    return aggregate.duplicate_ids(table(spark, folder, "normalised_record"), "source_ref")


@query(f"with {_MATRIX_SQL} select * from matrix")
def licence_matrix(spark, folder):
    return licensing.matrix(spark)


@query(f"""with {_PROVIDERS_SQL}, {_MATRIX_SQL}, used as (select distinct artifact_id, use_kind, unnest(provider_ids) as provider_id from corpus_artifact),
  known as (select u.*, p.kind, m.licence as permitted from used u left join providers p on split_part(u.provider_id, '.', 1) = p.prefix and u.provider_id in (select provider_id from corpus_record)
    left join matrix m on m.licence = p.licence and m.use_kind = u.use_kind)
  select artifact_id, provider_id, 'unknown_provider' as violation from known where kind is null
  union all select artifact_id, provider_id, 'licence' from known where kind is not null and permitted is null
  union all select artifact_id, provider_id, 'autophagy' from known where kind = 'internal' and use_kind = 'induction'""")
def licence_violations(spark, folder):
    return licensing.artifact_violations(table(spark, folder, "corpus_artifact"), _providers(spark, folder))


@query(f"with {_PROVIDERS_SQL}, {_MATRIX_SQL} select distinct provider_id from corpus_record join providers on split_part(provider_id, '.', 1) = prefix join matrix using (licence) where use_kind = 'induction'")
def induction_eligible(spark, folder):
    return _providers(spark, folder).join(F.broadcast(licensing.matrix(spark).where("use_kind = 'induction'")), "licence", "left_semi").select("provider_id")


def _descriptors(spark: SparkSession, folder: str) -> list[ProviderDescriptor]:
    """The providers, which are few."""
    return [ProviderDescriptor(r["provider_id"], r["provider_id"], ProviderKind(r["kind"]), LicenceClass(r["licence"])) for r in _providers(spark, folder).orderBy("provider_id").collect()]


def _blend(descriptors: list[ProviderDescriptor]) -> CorpusBlend:
    """Registry providers for everything, usage providers for saturation only."""
    roles = {ProviderKind.REGISTRY: frozenset(Use), ProviderKind.USAGE: frozenset({Use.SATURATION})}
    return CorpusBlend("blend-test", tuple(BlendEntry(d.id, roles[d.kind], 2.0 if d.kind == ProviderKind.REGISTRY else 0.5) for d in descriptors if d.kind in roles))


@query(f"""with {_PROVIDERS_SQL}, {_BASE} select normalized, provider_id, record_count, case when kind = 'registry' then 2.0::double else 0.5::double end as weight,
  record_count * case when kind = 'registry' then 2.0::double else 0.5::double end as weighted_count from saturation join providers on split_part(provider_id, '.', 1) = prefix where kind in ('registry', 'usage')""")
def blend_contributors(spark, folder):
    evidence = aggregate.saturation(_accepted(spark, folder))
    return licensing.contributors(evidence, licensing.blend_frame(spark, _blend(_descriptors(spark, folder))), Use.SATURATION).select("normalized", "provider_id", "record_count", "weight", "weighted_count")


@query(f"with {_PROVIDERS_SQL}, {_BASE} select distinct normalized from saturation join providers on split_part(provider_id, '.', 1) = prefix where kind = 'registry'")
def artifact_names(spark, folder):
    known = _descriptors(spark, folder)
    return artifact.build(Use.NOVELTY_REFERENCE, _blend(known), known, aggregate.saturation(_accepted(spark, folder))).names


@query(None)
def induction_artifact(spark, folder):
    """The clean induction names of the registries: gates, blended set, three exclusion keys (a phonetic code has no SQL form)."""
    known = _descriptors(spark, folder)
    return artifact.build(Use.INDUCTION, _blend(known), known, aggregate.saturation(_accepted(spark, folder)), _held(spark, folder)).names


@query("""select artifact_id, 'sha256:' || substr(sha256(concat_ws('|', use_kind, blend_id, array_to_string(list_sort(list_distinct(names)), '|'))), 1, 32) as content_id from corpus_artifact""")
def artifact_ids(spark, folder):
    a = table(spark, folder, "corpus_artifact")
    return a.select("artifact_id", artifact.id_column(F.col("use_kind"), F.col("blend_id"), F.col("names")).alias("content_id"))


@query(f"with {_BASE} select 'sha256:' || sha256(string_agg(normalized, chr(10) order by normalized)) as content_hash, count(*) as n_names from held")
def holdout_seal(spark, folder):
    return holdout.seal_frame(_held(spark, folder))


@query(f"with {_BASE} select distinct normalized from accepted where normalized in (select normalized from held)")
def holdout_exact(spark, folder):
    return _accepted(spark, folder).select("normalized").distinct().join(broadcast_if_small(_held(spark, folder)), "normalized", "left_semi")


_KEYS = """
c as (select distinct normalized from accepted),
hk as (select distinct k from (select unnest(list_append(list_transform(range(1, length(normalized) + 1), lambda i: substr(normalized, 1, i - 1) || substr(normalized, i + 1)), normalized)) as k from held)),
ck as (select normalized, unnest(list_append(list_transform(range(1, length(normalized) + 1), lambda i: substr(normalized, 1, i - 1) || substr(normalized, i + 1)), normalized)) as k from c)
"""


@query(f"with {_BASE}, {_KEYS} select distinct normalized, case when normalized in (select normalized from held) then 'exact' else 'edit_distance' end as key from ck where k in (select k from hk)")
def holdout_deletion(spark, folder):
    return holdout.near_contamination(_accepted(spark, folder), _held(spark, folder))


@query(None)
def holdout_contamination(spark, folder):
    return holdout.contamination(_accepted(spark, folder), _held(spark, folder)).where("key is not null")


@query(None)
def excluded_histogram(spark, folder):
    return holdout.excluded_histogram(holdout.contamination(_accepted(spark, folder), _held(spark, folder)))


@query(f"""with {_BASE},
  hk as (select distinct k from (select unnest(list_append(list_transform(range(1, length(normalized) + 1), lambda i: substr(normalized, 1, i - 1) || substr(normalized, i + 1)), normalized)) as k from held)),
  c as (select distinct artifact_id, lower(n) as normalized from (select artifact_id, unnest(names) as n from corpus_artifact where use_kind = 'induction') where n <> ''),
  ck as (select artifact_id, normalized, unnest(list_append(list_transform(range(1, length(normalized) + 1), lambda i: substr(normalized, 1, i - 1) || substr(normalized, i + 1)), normalized)) as k from c),
  hits as (select distinct artifact_id, normalized from ck where k in (select k from hk)),
  ranked as (select *, row_number() over (partition by artifact_id order by normalized) as r from hits)
  select artifact_id, count(*) as n_hits, string_agg(normalized, ',' order by normalized) filter (r <= 5) as samples from ranked group by 1""")
def contamination_samples(spark, folder):
    return artifact.contamination_samples(artifact.near_contaminated(table(spark, folder, "corpus_artifact"), _held(spark, folder)))


@query(None)
def artifact_check(spark, folder):
    return artifact.check(table(spark, folder, "corpus_artifact"), _providers(spark, folder), _held(spark, folder))


@query("select provider_id, arg_max(vintage, ledger_seq) as vintage, arg_max(byte_size, ledger_seq) as byte_size from snapshot_ledger group by 1")
def ledger_latest(spark, folder):
    return ledger.latest(table(spark, folder, "snapshot_ledger")).select("provider_id", "vintage", "byte_size")


@query("""select ledger_seq, provider_id, byte_size, previous_size from (select *, lag(byte_size) over (partition by provider_id order by ledger_seq) as previous_size from snapshot_ledger)
  where byte_size < previous_size * (1 - 0.1::double)""")
def ledger_truncations(spark, folder):
    return ledger.truncations(table(spark, folder, "snapshot_ledger")).select("ledger_seq", "provider_id", "byte_size", "previous_size")


@query("""with a as (select provider_id, vintage, min(ledger_seq) as s from snapshot_ledger group by 1, 2), n as (select provider_id, vintage, count(*) as n from corpus_record group by 1, 2),
  k as (select a.provider_id, a.vintage, coalesce(n, 0) as n_rows, lag(coalesce(n, 0)) over (partition by a.provider_id order by s) as previous_rows from a left join n using (provider_id, vintage))
  select *, coalesce(n_rows < previous_rows * (1 - 0.1::double), false) as refused from k""")
def observed_shrink(spark, folder):
    return ledger.observed_shrink(_records(spark, folder), table(spark, folder, "snapshot_ledger"))


@query("""select p_partkey as position, p_name as id, case when p_partkey % 97 = 0 then 'removed' when p_partkey % 89 = 0 then 'reordered' when p_partkey % 83 = 0 then 'changed' end as violation
  from part where p_partkey % 97 = 0 or p_partkey % 89 = 0 or p_partkey % 83 = 0""")
def inventory_diff(spark, folder):
    """The parts as a locked inventory against themselves with entries removed, renamed and changed."""
    locked = table(spark, folder, "part").select(F.col("p_partkey").alias("position"), F.col("p_name").alias("id"), F.sha2(F.concat_ws("|", "p_brand", "p_type"), 256).alias("fingerprint"))
    hit = lambda n: F.col("position") % n == 0
    now = locked.where(~hit(97)).select(
        "position", F.when(hit(89), F.concat("id", F.lit("!"))).otherwise(F.col("id")).alias("id"), F.when(hit(83), F.lit("other")).otherwise(F.col("fingerprint")).alias("fingerprint")
    )
    return inventory.diff(now, locked)


_FACTS = "f as (select user_id as candidate_id, event_type as source, case when event_type in ('purchase', 'signup') then 'registered' else 'free' end as status, value as confidence, ts as checked_at, ts + interval 30 day as expires_at from events)"


@query(f"""with {_FACTS} select candidate_id, source, status, confidence from (select *, row_number() over (partition by candidate_id order by confidence desc, checked_at desc, source desc) as r
  from f where checked_at <= timestamp '2024-01-15' and expires_at > timestamp '2024-01-15') where r = 1""")
def best_facts(spark, folder):
    return facts.best_facts(_facts(spark, folder), F.lit("2024-01-15").cast("timestamp_ntz")).select("candidate_id", "source", "status", "confidence")


_DECISIONS = "d as (select o_orderkey as decision_id, o_custkey as candidate_id, timestamp '2024-01-01' + (o_orderkey % 40) * interval 1 day as decided_at from orders)"


@query(f"""with {_FACTS}, {_DECISIONS} select decision_id, candidate_id, source, status, confidence from (select d.decision_id, d.candidate_id, f.source, f.status, f.confidence,
  row_number() over (partition by decision_id order by confidence desc, checked_at desc, source desc) as r from d join f on f.candidate_id = d.candidate_id and checked_at <= decided_at and decided_at < expires_at) where r = 1""")
def facts_at_decisions(spark, folder):
    decisions = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("decision_id"), F.col("o_custkey").alias("candidate_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("o_orderkey") % 40).cast("int"))).alias("decided_at"),
    )
    return facts.facts_at_decisions(_facts(spark, folder), decisions).select("decision_id", "candidate_id", "source", "status", "confidence")


@query(f"""with {_BASE} select normalized, round(least(1.0, total_count / 20.0), 6)::double as score, case when normalized in (select lower(normalized) from provider_counts where normalized is not null and provider_id like 'domlist.%')
  then 'taken' when total_count >= 10 then 'promote' else 'hold' end as level from totals""")
def cascade(spark, folder):
    totals = aggregate.convergence(aggregate.saturation(_accepted(spark, folder)))
    registered = table(spark, folder, "provider_counts").where(F.col("provider_id").startswith("domlist.")).select(F.lower("normalized").alias("name"))
    return facts.cascade(totals.select("normalized", F.round(F.least(F.lit(1.0), F.col("total_count") / 20), 6).alias("score")), registered, 0.5)


@query(f"""with {_FACTS}, l as (select candidate_id, max(checked_at) as last_checked, max(confidence) as score from f group by 1)
  select candidate_id, score, round(score * ((epoch(timestamp '2024-03-01')::bigint - floor(epoch(last_checked))::bigint) / 3600), 6) as priority from l
  order by score * ((epoch(timestamp '2024-03-01')::bigint - floor(epoch(last_checked))::bigint) / 3600) desc, candidate_id limit 50""")
def sweep_order(spark, folder):
    return facts.sweep_order(_facts(spark, folder), F.lit("2024-03-01").cast("timestamp_ntz"), 50).select("candidate_id", "score", F.round("priority", 6).alias("priority"))


@query(f"""with {_BASE}, {_KEYS}, hh as (select normalized as mark, unnest(list_append(list_transform(range(1, length(normalized) + 1), lambda i: substr(normalized, 1, i - 1) || substr(normalized, i + 1)), normalized)) as k from held),
  p as (select distinct normalized as candidate, mark from ck join hh using (k))
  select candidate, mark, case when candidate = mark then 'exact' else 'edit_distance' end as match_type, round(1 - levenshtein(candidate, mark) / greatest(length(candidate), length(mark)), 9) as similarity from p""")
def screening_signals(spark, folder):
    found = screening.signals(_accepted(spark, folder).select("normalized"), _held(spark, folder), phonetic=False)
    return found.withColumn("similarity", F.round("similarity", 9))


@query(None)
def screening_all_signals(spark, folder):
    """``screening_signals`` with the phonetic ones, which SQL can't express."""
    return screening.signals(_accepted(spark, folder).select("normalized"), _held(spark, folder)).withColumn("similarity", F.round("similarity", 9))


@query(None)
def screening_counts(spark, folder):
    return screening.signal_counts(screening.signals(_accepted(spark, folder).select("normalized"), _held(spark, folder)))


@query(f"""with {_BASE}, c as (select distinct normalized from accepted) select h.normalized, min(levenshtein(h.normalized, c.normalized)) as min_distance from held h cross join c group by 1""")
def novelty_min_distance(spark, folder):
    """The least edit distance of every held-out name, however far or long."""
    return screening.novelty(_held(spark, folder), _accepted(spark, folder))


@query(None)
def novelty_distances(spark, folder):
    return screening.novelty_distances(_held(spark, folder), _accepted(spark, folder))


@query(None)
def novelty_p95(spark, folder):
    return screening.novelty_summary(novelty_distances(spark, folder))


@query(f"""with {_BASE}, s as (select distinct normalized, translate(replace(replace(normalized, 'rn', 'm'), 'vv', 'w'), 'l1i0', 'iiio') as skeleton from accepted)
  select skeleton, normalized as name from s where skeleton in (select skeleton from s group by 1 having count(*) > 1)""")
def confusables(spark, folder):
    return screening.confusables(_accepted(spark, folder).select("normalized"))


@query(f"""with {_BASE}, r as (select total_count::double as x, row_number() over (order by total_count) as i, count(*) over () as n from totals)
  select round(2 * sum(i * x) / (max(n) * sum(x)) - (max(n) + 1) / max(n), 9) as gini from r""")
def usage_gini(spark, folder):
    totals = aggregate.convergence(aggregate.saturation(_accepted(spark, folder)))
    return evaluation.gini(totals, "total_count").select(F.round("gini", 9).alias("gini"))


@query(f"""with {_BASE}, n as (select distinct normalized from accepted), p as (select 'onset' as part, regexp_extract(normalized, '^([^aeiouy]*)', 1) as v from n union all
  select 'nucleus', regexp_extract(normalized, '^[^aeiouy]*([aeiouy]+)', 1) from n union all select 'coda', regexp_extract(normalized, '([^aeiouy]*)$', 1) from n),
  c as (select part, v, count(*) as c from p group by 1, 2), t as (select part, sum(c) as t from c group by 1)
  select part, round(-sum(c / t * log2(c / t)), 6) as entropy_bits from c join t using (part) group by 1""")
def part_entropy(spark, folder):
    names = _accepted(spark, folder).select("normalized").distinct()
    return evaluation.entropy(evaluation.syllable_parts(names), "part", "value").withColumn("entropy_bits", F.round("entropy_bits", 6))


@query(f"""with {_BASE}, g as (select unnest(list_transform(range(1, length(normalized) - 1), lambda i: substr(normalized, i, 3))) as g from (select distinct normalized from accepted))
  select count(distinct g) as n_distinct, count(*) as n_grams, round(count(distinct g) / count(*), 9) as distinct_share from g""")
def distinct_n(spark, folder):
    return evaluation.distinct_n(_accepted(spark, folder).select("normalized").distinct(), 3).withColumn("distinct_share", F.round("distinct_share", 9))


_BIGRAMS = """n as (select distinct normalized from accepted), tg as (select unnest(list_transform(range(1, length(normalized) + 2), lambda i: substr('^' || normalized || '$', i, 2))) as g from n),
  gc as (select g, count(*) as c from tg group by 1), cc as (select g[1] as x, sum(c) as t from gc group by 1),
  hs as (select normalized, unnest(list_transform(range(1, length(normalized) + 2), lambda i: substr('^' || normalized || '$', i, 2))) as g from held),
  ht as (select normalized, avg(ln((coalesce(c, 0) + 1) / (coalesce(t, 0) + 27))) as m from hs left join gc using (g) left join cc on cc.x = g[1] group by 1)"""


@query(f"with {_BASE}, {_BIGRAMS} select normalized, round(m, 6) as mean_log_prob from ht")
def bigram_typicality(spark, folder):
    found = evaluation.typicality(_held(spark, folder), _accepted(spark, folder).select("normalized").distinct())
    return found.withColumn("mean_log_prob", F.round("mean_log_prob", 6))


@query(f"""with {_BASE}, {_BIGRAMS}, r as (select round(m, 6) as m from ht), q as (select quantile_cont(m, 0.9) as t from r)
  select round((select t from q), 6) as threshold, count(*) filter (m >= (select t from q)) as n_above, count(*) as n_names from r""")
def typicality_top_decile(spark, folder):
    """The typicality that the best tenth of the held-out names reach."""
    found = evaluation.typicality(_held(spark, folder), _accepted(spark, folder).select("normalized").distinct()).withColumn("m", F.round("mean_log_prob", 6))
    return evaluation.at_least_as_typical(found, "m", 0.1).withColumn("threshold", F.round("threshold", 6))


@query(f"""with {_BASE}, t as (select regexp_replace(regexp_replace(normalized, '[^aeiouy]+', 'C', 'g'), '[aeiouy]+', 'V', 'g') as template, count(*) as n_names from (select distinct normalized from accepted) group by 1)
  select template, n_names, round(n_names / sum(n_names) over (), 9) as share from t""")
def template_distribution(spark, folder):
    return evaluation.template_distribution(_accepted(spark, folder).select("normalized").distinct()).withColumn("share", F.round("share", 9))


@query(f"""with {_BASE}, {_BIGRAMS}, ns as (select normalized, unnest(list_transform(range(1, length(normalized) + 2), lambda i: substr('^' || normalized || '$', i, 2))) as g from n),
  nt as (select normalized, avg(ln((coalesce(c, 0) + 1) / (coalesce(t, 0) + 27))) as m from ns left join gc using (g) left join cc on cc.x = g[1] group by 1),
  a as (select floor(round(m, 6) / 0.25) as b, count(*) / (select count(*) from nt) as p from nt group by 1), h as (select floor(round(m, 6) / 0.25) as b, count(*) / (select count(*) from ht) as p from ht group by 1)
  select round(sum(least(a.p, h.p)), 6) as overlap from a join h using (b)""")
def typicality_overlap(spark, folder):
    training = _accepted(spark, folder).select("normalized").distinct()
    rounded = lambda df: df.withColumn("mean_log_prob", F.round("mean_log_prob", 6))
    a, h = rounded(evaluation.typicality(training, training)), rounded(evaluation.typicality(_held(spark, folder), training))
    return evaluation.histogram_overlap(a, h, "mean_log_prob", 0.25).select(F.round("overlap", 6).alias("overlap"))


_LEVELS = ", ".join(f"l{k} as (select substr(gram, 2) as gram, count(*) as c from l{k + 1} group by 1)" for k in (4, 3, 2, 1))
_CONTEXTS = ", ".join(f"x{k} as (select substr(gram, 1, {k - 1}) as context, sum(c) as t, count(*) as f from l{k} group by 1)" for k in range(1, 6))


def _kneser_ney_sql() -> str:
    p = "(1 / 27.0::double)"
    for k in range(1, 6):
        p = f"(case when x{k}.t is null then {p} else (greatest(coalesce(l{k}.c, 0) - 0.75::double, 0) + 0.75::double * x{k}.f * {p}) / x{k}.t end)"
    joins = " ".join(f"left join l{k} on l{k}.gram = substr(q, {6 - k}, {k}) left join x{k} on x{k}.context = substr(q, {6 - k}, {k - 1})" for k in range(1, 6))
    grams = lambda source: f"select normalized, unnest(list_transform(range(1, length(normalized) + 2), lambda i: substr('^^^^' || normalized || '$', i, 5))) as q from {source}"
    return f"""with {_BASE}, n as (select distinct normalized from accepted), l5 as (select q as gram, count(*) as c from ({grams('n')}) group by 1), {_LEVELS}, {_CONTEXTS},
      s as (select normalized, avg(ln({p})) as m from ({grams('held')}) {joins} group by 1)
      select normalized, round(m, 6) as mean_log_prob, round((m - (select avg(m) from s)) / (select stddev_samp(m) from s), 6) as z from s"""


@query(_kneser_ney_sql())
def kneser_ney_typicality(spark, folder):
    found = evaluation.kneser_ney(_held(spark, folder), _accepted(spark, folder).select("normalized").distinct())
    return found.select("normalized", F.round("mean_log_prob", 6).alias("mean_log_prob"), F.round("z", 6).alias("z"))


@query(f"""with {_BASE} select count(*) as n_in, 'live' as gate, 0 as position, count(*) filter (status = 'live') as n_out from accepted
  union all select count(*) filter (status = 'live'), 'short', 1, count(*) filter (status = 'live' and length(normalized) <= 10) from accepted
  union all select count(*) filter (status = 'live' and length(normalized) <= 10), 'vowel', 2, count(*) filter (status = 'live' and length(normalized) <= 10 and regexp_matches(normalized, '[aeiouy]')) from accepted""")
def gate_yield(spark, folder):
    flags = _accepted(spark, folder).select((F.col("status") == "live").alias("live"), (F.length("normalized") <= 10).alias("short"), F.col("normalized").rlike("[aeiouy]").alias("vowel"))
    return evaluation.gate_yield(flags, ["live", "short", "vowel"])


@query("""with e as (select event_type as arm, value as x, (user_id % 100)::double as y from events), m as (select median(x) as mx, median(y) as my from e)
  select arm, count(*) filter (x >= mx and y >= my) as both, count(*) filter (x >= mx and y < my) as only_x, count(*) filter (x < mx and y >= my) as only_y, count(*) filter (x < mx and y < my) as neither from e cross join m group by 1""")
def frontier(spark, folder):
    e = table(spark, folder, "events").select(F.col("event_type").alias("arm"), F.col("value").alias("x"), (F.col("user_id") % 100).cast("double").alias("y"))
    return evaluation.frontier(e, "arm", "x", "y")


@query("""with r as (select (rank() over (order by o_totalprice) + (count(*) over (partition by o_totalprice) - 1) / 2) as a, (rank() over (order by o_custkey) + (count(*) over (partition by o_custkey) - 1) / 2) as b from orders)
  select round(corr(a, b), 6) as spearman from r""")
def rank_correlation(spark, folder):
    return evaluation.spearman(table(spark, folder, "orders"), "o_totalprice", "o_custkey").select(F.round("spearman", 6).alias("spearman"))


@query("""with u as (select doc_id, count(*) as m, sum(band) as s, sum(band * band) as q from reading_labels where band is not null group by 1 having count(*) > 1),
  t as (select sum(2 * (m * q - s * s) / (m - 1)) / sum(m) as o, 2 * (sum(m) * sum(q) - sum(s) * sum(s)) / (sum(m) * (sum(m) - 1)) as e from u) select round(1 - o / e, 9) as alpha from t""")
def rater_agreement(spark, folder):
    return evaluation.krippendorff_alpha(table(spark, folder, "reading_labels"), "doc_id", "band").select(F.round("alpha", 9).alias("alpha"))


_CENTROID = """d as (select label, i, avg(embedding[i]::double) as m from (select label, embedding, unnest(range(1, len(embedding) + 1)) as i from embeddings) group by 1, 2),
  cn as (select label as posture, list(m order by i) as c from d group by 1)"""
_COSINE = "list_dot_product(embedding::double[], c) / (sqrt(list_dot_product(embedding::double[], embedding::double[])) * sqrt(list_dot_product(c, c)))"


@query(f"with {_CENTROID} select vec_id, posture, round({_COSINE}, 6) as fit from embeddings cross join cn")
def posture_cosine(spark, folder):
    v = table(spark, folder, "embeddings")
    return scoring.posture_fit(v, scoring.centroids(v, "label", "embedding").withColumnRenamed("label", "posture")).select("vec_id", "posture", F.round("fit", 6).alias("fit"))


@query(f"with {_CENTROID} select vec_id, posture, round((0.7 * {_COSINE} + 0.3 * (vec_id % 10) / 10) / 1.0, 6) as composite from embeddings cross join cn")
def posture_composite(spark, folder):
    v = table(spark, folder, "embeddings")
    fits = scoring.posture_fit(v, scoring.centroids(v, "label", "embedding").withColumnRenamed("label", "posture")).withColumn("novelty", (F.col("vec_id") % 10) / 10)
    return scoring.composite(fits, {"fit": 0.7, "novelty": 0.3}).select("vec_id", "posture", F.round("composite", 6).alias("composite"))


@query("""select n_name as item, case when min(l_quantity) >= 1 then round(sum(l_extendedprice * l_quantity) / sum(l_extendedprice), 4) end as basket_score, min(l_quantity) as lowest
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by 1""")
def market_basket(spark, folder):
    markets = table(spark, folder, "lineitem").join(table(spark, folder, "supplier").join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")), F.col("l_suppkey") == F.col("s_suppkey"))
    found = scoring.market_basket(markets.select(F.col("n_name").alias("item"), F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("w")), "item", "q", "w", 1.0)
    return found.withColumn("basket_score", F.round("basket_score", 4))


@query("select idx, (idx % 7)::int as d0, ((idx // 7) % 11)::int as d1, ((idx // 77) % 13)::int as d2 from range(0, 100100) t(idx)")
def mixed_radix_decode(spark, folder):
    df = addressing.enumerate_range(spark, 0, 100_100)
    return df.select("idx", *[d.alias(f"d{i}") for i, d in enumerate(addressing.decode(F.col("idx"), [7, 11, 13]))])


@query("""with w as (select event_type as choice, count(*) as weight from events group by 1), e as (select choice, weight * 1024 / sum(weight) over () as e from w), f as (select choice, floor(e)::bigint as f, e - floor(e) as r from e),
  s as (select choice, f + case when row_number() over (order by round(r, 9) desc, choice) <= 1024 - sum(f) over () then 1 else 0 end as n_slots from f)
  select choice, (sum(n_slots) over (order by choice) - n_slots)::bigint as first_slot, n_slots::bigint as n_slots from s""")
def weighted_slots(spark, folder):
    return addressing.slots(table(spark, folder, "events").groupBy(F.col("event_type").alias("choice")).agg(F.count("*").alias("weight")))


POSITIONS = {"onset": ["k", "t", "m", "l", "br"], "nucleus": ["a", "i", "o"], "middle": ["rv", "n", "st", "l"], "end": ["a", "on", "ix", "um", "e"]}


@query("""select idx, ['k', 't', 'm', 'l', 'br'][idx % 5 + 1] || ['a', 'i', 'o'][(idx // 5) % 3 + 1] || ['rv', 'n', 'st', 'l'][(idx // 15) % 4 + 1] || ['a', 'on', 'ix', 'um', 'e'][(idx // 60) % 5 + 1] as surface from range(0, 300) t(idx)""")
def built_names(spark, folder):
    return addressing.build(addressing.enumerate_range(spark, 0, 300), POSITIONS)


@query("select 10000019::bigint as n_rows, 10000019::bigint as n_distinct, 0::bigint as least, 10000018::bigint as greatest")
def feistel_bijection(spark, folder):
    """Ten million indices permuted: no two alike. Each is counted by its value, so no task holds them all."""
    size = 10_000_019
    moved = addressing.enumerate_range(spark, 0, size).select(addressing.permuted(F.col("idx"), size, 42).alias("at"))
    by_value = moved.groupBy("at").agg(F.count("*").alias("n"))
    return by_value.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_distinct"), F.min("at").alias("least"), F.max("at").alias("greatest"))


@query("select 0::bigint as n_different, 300::bigint as n_rows")
def shard_equivalence(spark, folder):
    """The same range enumerated in one and in three shards, permuted: no row differs."""
    whole = addressing.build(addressing.enumerate_range(spark, 0, 300), POSITIONS, key=7)
    parts = [addressing.build(addressing.enumerate_range(spark, a, b), POSITIONS, key=7) for a, b in ((0, 100), (100, 101), (101, 300))]
    split = parts[0].unionByName(parts[1]).unionByName(parts[2])
    both = whole.select("idx", F.col("surface").alias("a")).join(split, "idx", "full")
    return both.agg(F.count_if(~F.col("a").eqNullSafe(F.col("surface"))).alias("n_different"), F.count("*").alias("n_rows"))


#: The letters of the test names as a language: sonority, vowels, longest cluster, letters that every language of a list can say (values of these queries).
LETTERS = phonology.LanguagePack(
    "letters", {c: rank for rank, group in enumerate(("ptkbdgqcjx", "sfvzh", "mn", "lr", "w", "aeiouy"), 1) for c in group}, frozenset("aeiouy"), 3, frozenset("aeioumnptksl"),
)


@query(f"""with {_BASE}, c as (select distinct normalized from accepted) select normalized, case when regexp_matches(normalized, '[^aeiouy]{{4}}') then 'cluster' when regexp_matches(normalized, '[aeiouy]{{2}}') then 'hiatus'
  when regexp_matches(normalized, '(aa|bb|cc|dd|ee|ff|gg|hh|ii|jj|kk|ll|mm|nn|oo|pp|qq|rr|ss|tt|uu|vv|ww|xx|yy|zz)') then 'repeat'
  when not regexp_full_match(translate(regexp_extract(normalized, '^[^aeiouy]*'), 'ptkbdgqcjxsfvzhmnlrw', '11111111112222233445'), '1?2?3?4?5?') then 'sonority'
  when not regexp_full_match(normalized, '[aeioumnptksl]+') then 'unsafe' end as failed_gate from c""")
def gate_funnel(spark, folder):
    letters, onset = F.split("normalized", ""), F.regexp_extract("normalized", "^[^aeiouy]*", 0)
    checks = [
        ("cluster", phonology.clusters_within(letters, LETTERS)), ("hiatus", phonology.no_hiatus(letters, LETTERS)), ("repeat", phonology.no_repeat(letters)),
        ("sonority", phonology.sonority_rises(F.when(onset == "", F.array().cast("array<string>")).otherwise(F.split(onset, "")), LETTERS)), ("unsafe", phonology.globally_safe(letters, LETTERS)),
    ]
    return phonology.gates(_accepted(spark, folder).select("normalized").distinct(), checks)


@query(f"""with {_BASE}, c as (select distinct normalized, regexp_replace(normalized, '[aeiouy]', '', 'g') as skeleton from accepted), r as (select c.skeleton, c.normalized, total_count,
  row_number() over (partition by skeleton order by total_count desc, c.normalized) as rank from c join totals using (normalized)) select skeleton as phonoform_id, normalized as surface, rank from r where rank <= 8""")
def top_variants(spark, folder):
    totals = aggregate.convergence(aggregate.saturation(_accepted(spark, folder)))
    variants = totals.select(
        F.regexp_replace("normalized", "[aeiouy]", "").alias("phonoform_id"), F.col("normalized").alias("surface"), F.col("total_count").alias("fidelity"), F.lit(0).alias("frequency"), F.lit("").alias("register")
    )
    return phonology.top_variants(variants).select("phonoform_id", "surface", "rank")


@query("""select date_trunc('hour', ts)::varchar as window_start, event_type as source, count(*) as n_facts, round(avg(value), 6) as mean_confidence from events group by 1, 2""")
def windowed_facts(spark, folder):
    found = streams.windowed_counts(_facts(spark, folder))
    return found.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "source", "n_facts", F.round("mean_confidence", 6).alias("mean_confidence"))


@query("""select user_id as candidate_id, value as confidence, event_type as source, ts as checked_at from (select *, row_number() over (partition by user_id order by value desc, ts desc, event_type desc) as r from events) where r = 1""")
def streamed_best_facts(spark, folder):
    """The events read as a stream, the best fact per candidate kept as state over micro-batches; equal to the batch result."""
    events = spark.readStream.schema(table(spark, folder, "events").schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "events*").parquet(f"{folder}/events.parquet*")
    rows = events.select(F.col("user_id").alias("candidate_id"), F.col("event_type").alias("source"), F.lit("free").alias("status"), F.col("value").alias("confidence"), F.col("ts").alias("checked_at"))
    place, state = scratch_path(spark, "best"), scratch_path(spark, "state")
    streams.upsert_best(rows, place, state).awaitTermination()
    return streams.best_so_far(spark, place).select("candidate_id", "confidence", "source", "checked_at")


@query("""with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minute then 0 else 1 end as fresh from events),
  s as (select user_id, ts, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as k from g)
  select user_id, count(distinct k) as n_sessions, count(*) as n_events from s group by 1""")
def user_sessions(spark, folder):
    found = streams.sessions(table(spark, folder, "events"))
    return found.groupBy("user_id").agg(F.count("*").alias("n_sessions"), F.sum("n_events").alias("n_events"))


@query("""select norm_id, round(len(list_intersect(tags, ['abandoned', 'probable_acronym'])) / len(list_distinct(list_concat(tags, ['abandoned', 'probable_acronym']))), 9) as score
  from normalised_record where list_has_any(tags, ['abandoned', 'probable_acronym'])""")
def tag_retrieval(spark, folder):
    wanted = F.array(F.lit("abandoned"), F.lit("probable_acronym"))
    met = table(spark, folder, "normalised_record").where(F.arrays_overlap("tags", wanted))
    return met.select("norm_id", F.round(scoring.tag_overlap(F.col("tags"), wanted), 9).alias("score"))


@query("""select norm_id, len(list_intersect(tags, ['abandoned', 'probable_acronym'])) / len(list_distinct(list_concat(tags, ['abandoned', 'probable_acronym']))) as score from normalised_record
  where list_has_any(tags, ['abandoned', 'probable_acronym']) order by score desc, norm_id limit 15""")
def best_retrieved(spark, folder):
    names = table(spark, folder, "normalised_record").select("norm_id", F.format_string("%012d", "norm_id").alias("normalized"), "tags")
    return scoring.retrieve(names, ["abandoned", "probable_acronym"]).select("norm_id", "score")


@query("select run_id, normalized, provider_id, record_count, rank() over (partition by run_id order by record_count desc nulls last) as rank from provider_counts")
def run_ranking(spark, folder):
    scores = table(spark, folder, "provider_counts").withColumn("score", F.col("record_count"))
    return facts.run_ranking(scores).select("run_id", "normalized", "provider_id", "record_count", "rank")


@query("select run_id, count(*) as n_calls, sum(record_count)::bigint as tokens, sum(live)::bigint as cost_cents from provider_counts group by 1")
def run_costs(spark, folder):
    return facts.run_costs(table(spark, folder, "provider_counts").select("run_id", F.col("record_count").alias("tokens"), F.col("live").alias("cost_cents")))


@query("""with v as (select user_id // 10 as candidate_id, user_id as voter, arg_max(event_type, ts) as choice from events group by 1, 2) select candidate_id, choice, count(*) as n_votes from v group by 1, 2""")
def vote_tally(spark, folder):
    votes = table(spark, folder, "events").select(F.floor(F.col("user_id") / 10).alias("candidate_id"), F.col("user_id").alias("voter"), F.col("ts").alias("at"), F.col("event_type").alias("choice"))
    return facts.tally(votes)


@query(f"with {_FACTS} select source, max(checked_at) as last_checked, count(*) filter (expires_at <= timestamp '2024-02-15') as n_expired from f group by 1")
def fact_freshness(spark, folder):
    return facts.freshness(_facts(spark, folder), F.lit("2024-02-15").cast("timestamp_ntz"))


_SHARES = "p as (select l_suppkey as item, l_returnflag as dimension, l_discount as value, l_quantity as salience, l_tax as weight, l_linenumber = 1 as is_head from lineitem)"


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("item"), F.col("l_returnflag").alias("dimension"), F.col("l_discount").alias("value"), F.col("l_quantity").alias("salience"), F.col("l_tax").alias("weight"),
        (F.col("l_linenumber") == 1).alias("is_head"),
    )


@query(f"with {_SHARES} select item, dimension, round(sum(value * salience) / sum(salience) + (item % 3) / 100.0::double, 6) as value from p group by 1, 2")
def connotation(spark, folder):
    parts = _parts(spark, folder)
    shifts = parts.select("item", "dimension").distinct().withColumn("shift", (F.col("item") % 3) / 100)
    return scoring.connotation(parts, shifts).select("item", "dimension", F.round("value", 6).alias("value"))


@query(f"with {_SHARES} select item, dimension as concept, round(max(weight * case when is_head then 1 else 0.5 end), 6)::double as weight from p group by 1, 2")
def denotation(spark, folder):
    return scoring.denotation(_parts(spark, folder).withColumnRenamed("dimension", "concept")).select("item", "concept", F.round("weight", 6).alias("weight"))


@query(f"with {_SHARES} select item, dimension as domain, round(max(weight * value), 6) as value from p group by 1, 2")
def domain_fit(spark, folder):
    return scoring.domain_fit(_parts(spark, folder).withColumnRenamed("dimension", "domain")).select("item", "domain", F.round("value", 6).alias("value"))


@query(f"""with {_BASE} select normalized, case when length(normalized) between 5 and 8 then 1.0 when length(normalized) <= 3 or length(normalized) >= 14 then 0.0 when length(normalized) < 5
  then (length(normalized) - 3) / 2.0 else round((14 - length(normalized)) / 6.0, 6) end::double as length_score,
  round(((case when contains(substr(normalized, 2), normalized[1]) then 1 else 0 end) + (case when length(normalized) <= 8 then 1 else 0 end)
  + (case when len(list_filter(range(1, length(normalized) - 2), lambda i: contains(substr(normalized, i + 2), substr(normalized, i, 2)))) > 0 then 1 else 0 end)) / 3.0, 6)::double as memorable from (select distinct normalized from accepted)""")
def name_scores(spark, folder):
    names, n = _accepted(spark, folder).select("normalized").distinct(), F.col("normalized")
    return names.select("normalized", F.round(scoring.length_curve(F.length(n), 3, 5, 8, 14), 6).alias("length_score"), F.round(scoring.memorability(n), 6).alias("memorable"))


@query(f"""with {_BASE} select normalized, unnest(list_distinct([translate(normalized, 'aeiou', 'eioua'), regexp_replace(normalized, '[aeiouy]([^aeiouy]*)$', '\\1'),
  substr(normalized, length(normalized) // 2 + 1) || substr(normalized, 1, length(normalized) // 2)])) as mutation from held""")
def lexical_mutations(spark, folder):
    return _held(spark, folder).select("normalized", F.explode(phonology.mutations(F.col("normalized"))).alias("mutation"))


@query(f"with {_BASE} select distinct normalized from accepted where normalized not in (select normalized from held where length(normalized) > 7)")
def safety_gate(spark, folder):
    lexicon = _held(spark, folder).select(F.col("normalized").alias("word"), F.lit("xx").alias("language"), F.when(F.length("normalized") > 7, "blocking").otherwise("mild").alias("severity"))
    return screening.lexicon_gate(_accepted(spark, folder).select("normalized").distinct(), lexicon)


@query("""select surface, count(*) as n_derivations from (select ['k', 't', 'm', 'l', 'br'][i % 5 + 1] || ['a', 'i', 'o'][(i // 5) % 3 + 1] || ['rv', 'n', 'st', 'l'][(i // 15) % 4 + 1] || ['a', 'on', 'ix', 'um', 'e'][(i // 60) % 5 + 1] as surface
  from (select idx % 300 as i from range(0, 450) t(idx))) group by 1 having count(*) > 1""")
def convergent_derivations(spark, folder):
    """Indices beyond the space wrap around: the surfaces that are then derived twice."""
    return addressing.duplicates(addressing.build(addressing.enumerate_range(spark, 0, 450), POSITIONS))


@query("select ledger_seq, previous_size, round(1.0::double - byte_size / previous_size, 9) as lost_share from (select *, lag(byte_size) over (partition by provider_id order by ledger_seq) as previous_size from snapshot_ledger)")
def ledger_steps(spark, folder):
    return ledger.steps(table(spark, folder, "snapshot_ledger")).select("ledger_seq", "previous_size", F.round("lost_share", 9).alias("lost_share"))


@query("""with a as (select event_type as arm, count(*) as n, avg((value > 10)::int::double) as p from events group by 1), z as (select *, abs(p - 0.5) / sqrt(0.25 / n) as z from a), t as (select *, 1 / (1 + 0.3275911 * z / sqrt(2.0)) as t from z)
  select arm, n as n_answers, round(p, 9) as accuracy,
    round(t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * exp(-z * z / 2), 6) as p_value from t""")
def forced_choice(spark, folder):
    answers = table(spark, folder, "events").select(F.col("event_type").alias("arm"), (F.col("value") > 10).alias("is_right"))
    return scoring.forced_choice(answers).select("arm", "n_answers", F.round("accuracy", 9).alias("accuracy"), F.round("p_value", 6).alias("p_value"))