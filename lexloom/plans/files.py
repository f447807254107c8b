"""Queries over files: each writes the tables in a delivered form to the shared folder first and reads that with the engine's readers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lexloom.operators import artifact, facts, holdout, inventory, ledger, membership
from lexloom.plans.reference import _BASE, _FACTS, _MATRIX_SQL, _PROVIDERS_SQL, _WS, Query, _accepted, _facts, _held, _providers, _records
from lexloom.session import scratch_path, table
from lexloom.sources import fixture, registry_csv, tolerant
from lexloom.streaming import facts as streams

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def kept(f: Query) -> Query:
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return kept


_STRIPPED = lambda c: f"regexp_replace(coalesce({c}, ''), '^{_WS}+|{_WS}+$', '', 'g')"
_DELIVERED = f"""
delivered as (select text, {_STRIPPED('source_ref')} as source_ref, case when upper({_STRIPPED('status')}) in ('L', 'LIVE', '1', 'Y') then 'live' when upper({_STRIPPED('status')}) in ('D', 'DEAD', '0', 'N') then 'dead' else 'unknown' end as status,
  first_seen_year, {_STRIPPED("source_fields['drawing_code']")} as drawing_code, record_id from corpus_record),
kept as (select * from delivered where drawing_code in ('4', '5') and {_STRIPPED('text')} <> '')
"""


def _delivery(spark: SparkSession, folder: str) -> str:
    """The corpus records as a registry's CSV files, under headers of their own; returns their folder."""
    place, r = scratch_path(spark, "registry"), _records(spark, folder)
    r.select(
        F.col("source_ref").alias("Serial_No "), F.col("text").alias("MARK_IDENTIFICATION"), F.try_element_at("source_fields", F.lit("drawing_code")).alias("draw_cd"),
        F.concat(F.format_string("%04d", "first_seen_year"), F.lit("0101")).alias("filing_date"), F.lit("700").alias("status_code"), F.col("status").alias("live_dead_ind"),
    ).write.csv(place, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return place


@query(f"with {_DELIVERED} select text, source_ref, status, first_seen_year, drawing_code from kept")
def registry_records(spark, folder):
    """Registry files read strictly: header bound by candidates, years and flags decoded, source filters."""
    found = registry_csv.read(spark, _delivery(spark, folder))
    return found.select("text", "source_ref", "status", "first_seen_year", F.element_at("source_fields", "drawing_code").alias("drawing_code"))


@query(f"with {_DELIVERED} select 2030 as vintage, count(*) as n_rows, 1.0::double as standard_share, count(distinct text) as n_texts from kept")
def registry_landed(spark, folder):
    """The same landed as typed Parquet of a vintage, validated, and read again."""
    records, place = registry_csv.read(spark, _delivery(spark, folder)), scratch_path(spark, "landed")
    registry_csv.land(records, place, "2030", "sha256:0")
    landed = spark.read.parquet(place)
    checked = registry_csv.validation(landed).select("n_rows", "standard_share")
    texts = landed.groupBy("vintage", "text").agg(F.lit(1)).groupBy("vintage").agg(F.count("text").alias("n_texts"))
    return texts.withColumns({c: checked.select(c).scalar() for c in ("n_rows", "standard_share")})


_LINES = "l as (select record_id, record_id % 5000 as serial, record_id % 50 = 0 as is_cut from corpus_record), twice as (select serial from l where not is_cut group by 1 having count(*) > 1)"


@query(f"""with {_LINES} select 'malformed' as reason, count(*) as n_rows from l where is_cut having count(*) > 0 union all select 'duplicate_serial', count(*) from l where not is_cut and serial in (select serial from twice) having count(*) > 0
  union all select 'kept', count(*) from l where not is_cut and serial not in (select serial from twice)""")
def registry_quarantine(spark, folder):
    """A delivery with cut lines and repeated serials: what is kept apart, by reason, and what is kept."""
    place, header = scratch_path(spark, "quarantine"), "serial_no,mark_id_char,mark_draw_cd,filing_dt,status_cd,live_dead_ind"
    whole = F.concat_ws(",", F.concat(F.lit("s"), (F.col("record_id") % 5000).cast("string")), F.lit("NAME"), F.lit("4"), F.lit("20200101"), F.lit("700"), F.lit("L"))

    def headed(batches):
        yield pd.DataFrame({"value": [header]})
        yield from batches

    lines = _records(spark, folder).select(F.when(F.col("record_id") % 50 == 0, F.substring_index(whole, ",", 3)).otherwise(whole).alias("value"))
    lines.mapInPandas(headed, "value string").write.text(place)
    good, bad = registry_csv.read_quarantining(spark, place)
    reasons = bad.groupBy("reason").agg(F.count("*").alias("n_rows"))
    return reasons.unionByName(good.agg(F.count("*").alias("n_rows")).select(F.lit("kept").alias("reason"), "n_rows"))


@query("select display as text, lower(display) as source_ref, status, 2020 as first_seen_year, count(*) as n_rows from (select coalesce(replace(display, chr(9), ' '), '') as display, coalesce(status, '') as status from normalised_record) where trim(display) <> '' or trim(status) <> '' group by all")
def fixture_lines(spark, folder):
    """Names and their status as tab-separated lines, read back as records."""
    place = scratch_path(spark, "fixture")
    table(spark, folder, "normalised_record").select(F.concat_ws("\t", F.coalesce(F.replace("display", F.lit("\t"), F.lit(" ")), F.lit("")), F.coalesce("status", F.lit(""))).alias("value")).write.text(place)
    return fixture.read_tsv(spark, place, "local").groupBy("text", "source_ref", "status", "first_seen_year").agg(F.count("*").alias("n_rows"))


@query(f"""with {_PROVIDERS_SQL}, {_MATRIX_SQL}, used as (select distinct artifact_id, use_kind, unnest(provider_ids) as provider_id from corpus_artifact),
  known as (select u.*, p.kind, m.licence as permitted from used u left join providers p on split_part(u.provider_id, '.', 1) = p.prefix and u.provider_id in (select provider_id from corpus_record)
    left join matrix m on m.licence = p.licence and m.use_kind = u.use_kind)
  select artifact_id, 'unknown_provider' as violation, provider_id as detail from known where kind is null union all select artifact_id, 'licence', provider_id from known where kind is not null and permitted is null
  union all select artifact_id, 'autophagy', provider_id from known where kind = 'internal' and use_kind = 'induction' union all select artifact_id, 'no_holdout', '' from corpus_artifact where use_kind = 'induction'""")
def artifact_files(spark, folder):
    """All artifacts as JSON documents, read from their files and checked again, with no held-out names sealed."""
    place = scratch_path(spark, "artifacts")
    body = F.struct(F.lit(artifact.ARTIFACT_SCHEMA).alias("schema"), "artifact_id", F.col("use_kind").alias("use"), "blend_id", "provider_ids", "names", "excluded_by_holdout")
    documents = table(spark, folder, "corpus_artifact").select(F.to_json(body).alias("value"), F.sha2("artifact_id", 256).alias("file"))
    documents.write.partitionBy("file").text(place)
    return artifact.check(artifact.read_json(spark, f"{place}/*/*.txt"), _providers(spark, folder), None)


@query(f"with {_BASE} select artifact_id, coalesce(len(names), 0)::bigint as n_names, 'sha256:' || substr(sha256(concat_ws('|', use_kind, blend_id, array_to_string(list_sort(list_distinct(names)), '|'))), 1, 32) as content_id from corpus_artifact where names is not null order by artifact_id limit 1")
def artifact_round_trip(spark, folder):
    """The first artifact, rebuilt from its names, written as sorted files with a manifest, and read back: the content address stays."""
    from lexloom.types import Use

    row = table(spark, folder, "corpus_artifact").where("names is not null").orderBy("artifact_id").select("artifact_id", "use_kind", "blend_id", "provider_ids", F.size("names").alias("n")).first()
    names = table(spark, folder, "corpus_artifact").where(F.col("artifact_id") == row["artifact_id"]).select(F.explode("names").alias("normalized")).where("normalized is not null").distinct()
    place = scratch_path(spark, "artifact")
    artifact.CorpusArtifact(Use(row["use_kind"]), row["blend_id"], tuple(row["provider_ids"] or ()), names, {}).write(place)
    again = artifact.CorpusArtifact.read(spark, place)
    return spark.createDataFrame([(row["artifact_id"], row["n"], again.artifact_id)], "artifact_id string, n_names bigint, content_id string")


@query("""select n_nationkey::bigint as position, n_name as id, case when n_nationkey % 5 = 2 then 'changed' when n_nationkey % 5 = 3 then 'reordered' end as violation from nation where n_nationkey % 5 in (2, 3) and n_nationkey < 20
  union all select n_nationkey::bigint, n_name, 'removed' from nation where n_nationkey >= 20""")
def inventory_breaches(spark, folder):
    """An inventory against its lock, by fingerprints: some entries changed, renamed or gone, others only described anew, which is no breach."""
    entries = [{"id": r["n_name"], "weight": r["n_regionkey"], "notes": "old"} for r in table(spark, folder, "nation").orderBy("n_nationkey").collect()]
    lock = inventory.build_lock(entries)["entries"]
    kinds = {1: {"notes": "new", "gloss": "also new"}, 2: {"weight": 99}, 3: {"id": "other"}}
    now = [e | kinds.get(i % 5, {}) for i, e in enumerate(entries[:20])]
    frame = lambda pairs: inventory.entries_frame(spark, pairs)
    return inventory.diff(frame((e["id"], inventory.canonical_fingerprint(e)) for e in now), frame((e["id"], e["fingerprint"]) for e in lock))


@query("""with recursive o as (select *, row_number() over (partition by provider_id order by ledger_seq) as i from snapshot_ledger),
  r as (select provider_id, ledger_seq, byte_size, i, true as accepted, byte_size as last from o where i = 1
    union all select o.provider_id, o.ledger_seq, o.byte_size, o.i, not (r.last > 0 and o.byte_size < r.last * (1 - 0.1::double)), case when r.last > 0 and o.byte_size < r.last * (1 - 0.1::double) then r.last else o.byte_size end from r join o on o.provider_id = r.provider_id and o.i = r.i + 1)
  select ledger_seq, provider_id, byte_size, coalesce(accepted, true) as accepted from r""")
def ledger_replayed(spark, folder):
    """Every delivery checked against the last accepted one before it."""
    return ledger.replayed(table(spark, folder, "snapshot_ledger"))


@query(f"""with {_BASE}, h as (select 'sha256:' || sha256(string_agg(normalized, chr(10) order by normalized)) as content_hash, count(*) as n_names from held),
  g as (select 'sha256:' || sha256(string_agg(normalized, chr(10) order by normalized)) as content_hash, count(*) as n_names from held where normalized <> (select min(normalized) from held))
  select 'as sealed' as names, content_hash, n_names, true as is_sealed, n_names >= 50 as is_enough from h union all select 'one is missing', content_hash, n_names, false, n_names >= 50 from g""")
def seal_verification(spark, folder):
    """The held-out names against their seal, whole and with one name missing."""
    held = _held(spark, folder)
    sealed = holdout.seal_frame(held).first()["content_hash"]
    least = held.agg(F.min("normalized")).scalar()
    checks = [("as sealed", held), ("one is missing", held.where(F.col("normalized") != least))]
    found = [holdout.seal_check(names, sealed).select(F.lit(what).alias("names"), "*") for what, names in checks]
    return found[0].unionByName(found[1])


@query(f"with {_BASE} select distinct normalized as name from accepted")
def zone_names(spark, folder):
    """The accepted names as the owner names of a zone file, with sub-domains, comments and other zones between, read as registered names."""
    place = scratch_path(spark, "zone")
    line = F.when(F.col("record_id") % 3 == 0, F.concat(F.lit("www."), "normalized", F.lit(".com. 3600 IN NS a."))).otherwise(F.concat(F.upper("normalized"), F.lit(".com 3600 in a b")))
    lines = _accepted(spark, folder).select(F.explode(F.array(line, F.lit("; a comment"), F.concat("normalized", F.lit("x.org. in ns d")))).alias("value"))
    lines.write.text(place)
    return fixture.read_zone(spark, place, "com")


@query(f"""with {_BASE}, r as (select distinct lower(normalized) as n from provider_counts where normalized is not null), c as (select distinct normalized from accepted)
  select (select count(*) from r) as n_registered, count(*) as n_asked, 0::bigint as n_missed, true as few_false from c""")
def registered_filter(spark, folder):
    """A Bloom filter of registered names asked for all accepted ones: none that is registered is missed, and at most one in two hundred others is let through."""
    registered = table(spark, folder, "provider_counts").select(F.lower("normalized").alias("name")).where("name is not null").distinct()
    n = registered.count()
    blocks = membership.blocks_for(n)
    names = _accepted(spark, folder).select("normalized").distinct()
    asked = membership.might_hold(names, "normalized", membership.bloom_filter(registered, "name", blocks), blocks)
    truth = asked.join(registered.select(F.col("name").alias("normalized"), F.lit(True).alias("is_there")), "normalized", "left").withColumn("is_there", F.coalesce("is_there", F.lit(False)))
    return truth.agg(
        F.lit(n).cast("bigint").alias("n_registered"), F.count("*").alias("n_asked"), F.count_if(F.col("is_there") & ~F.col("might_hold")).alias("n_missed"),
        (F.count_if(~F.col("is_there") & F.col("might_hold")) <= 3 + F.count_if(~F.col("is_there")) / 200).alias("few_false"),
    )


@query("select record_id::varchar as serial, trim(text) as text, '700' as status_code, first_seen_year || '0101' as filing_date from corpus_record where regexp_full_match(text, '[A-Za-z ]*[A-Za-z]+')")
def daily_xml(spark, folder):
    """Plain names as the daily XML product, and read as rows."""
    place = scratch_path(spark, "xml")
    header = F.struct(F.col("text").alias("mark-identification"), F.lit("700").alias("status-code"), F.concat(F.col("first_seen_year").cast("string"), F.lit("0101")).alias("filing-date"))
    plain = _records(spark, folder).where(F.col("text").rlike(r"^[A-Za-z ]*[A-Za-z]+\z"))
    plain.select(F.col("record_id").cast("string").alias("serial-number"), header.alias("case-file-header")).write.xml(place, rowTag="case-file", rootTag="trademark-applications-daily")
    return fixture.read_daily_xml(spark, place)


@query("select norm_id, display, status, provider_id, first_seen_year from normalised_record")
def documents_of_a_newer_schema(spark, folder):
    """Rows written with fields this reader doesn't know, read, written and read again: nothing is lost."""
    from pyspark.sql import types as T

    first, second = scratch_path(spark, "newer"), scratch_path(spark, "newer")
    table(spark, folder, "normalised_record").select(F.to_json(F.struct("norm_id", "display", "status", "provider_id", "first_seen_year"), {"ignoreNullFields": "false"}).alias("value")).write.text(first)
    known = T.StructType([T.StructField("norm_id", T.LongType()), T.StructField("display", T.StringType())])
    tolerant.write(tolerant.read(spark, first, known), second)
    again = spark.read.schema("norm_id bigint, display string, status string, provider_id string, first_seen_year int").json(second)
    return again.select("norm_id", "display", "status", "provider_id", "first_seen_year")


@query(f"with {_FACTS}, d as (select distinct candidate_id, source, status, confidence, checked_at from f) select checked_at::date as checked_date, count(*) as n_facts from d group by 1")
def appended_history(spark, folder):
    """Facts streamed into the history once, though each file is delivered twice; partitioned by day."""
    place, state, source = scratch_path(spark, "history"), scratch_path(spark, "state"), scratch_path(spark, "twice")
    delivered = _facts(spark, folder).withColumns({c: F.col(c).cast("timestamp") for c in ("checked_at", "expires_at")})
    delivered.unionByName(delivered).write.parquet(source)
    streams.append_history(spark.readStream.schema(delivered.schema).parquet(source), place, state, delay="90 days").awaitTermination()
    return spark.read.parquet(place).groupBy("checked_date").agg(F.count("*").alias("n_facts"))


@query(f"with {_FACTS} select checked_at::date as checked_date, count(*) as n_facts, count(distinct candidate_id) as n_candidates from f where checked_at >= timestamp '2024-01-10' and checked_at < timestamp '2024-01-20' group by 1")
def history_of_days(spark, folder):
    """Facts appended in two deliveries to the history, of which ten days are read: the folders of other days aren't."""
    place, known = scratch_path(spark, "facts"), _facts(spark, folder)
    for part in (0, 1):
        facts.append(known.where(F.col("candidate_id") % 2 == part), place)
    days = spark.read.parquet(place).where(F.col("checked_date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-19").cast("date")))
    by_candidate = days.groupBy("checked_date", "candidate_id").agg(F.count("*").alias("n"))
    return by_candidate.groupBy("checked_date").agg(F.sum("n").alias("n_facts"), F.count("*").alias("n_candidates"))


@query("select user_id % 4 as organization_id, count(*) as n_rows, sum(value) as total from events where user_id % 4 = 3 group by 1")
def rows_of_a_tenant(spark, folder):
    """Rows of four organizations in one table, of which one's are read."""
    place = scratch_path(spark, "tenants")
    facts.write_by_tenant(table(spark, folder, "events").withColumn("organization_id", F.col("user_id") % 4), place)
    mine = facts.read_of_tenant(spark, place, "3")
    return mine.groupBy(F.col("organization_id").cast("bigint").alias("organization_id")).agg(F.count("*").alias("n_rows"), F.sum("value").alias("total"))
