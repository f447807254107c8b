"""Queries of building, judging and finding names: grammar, morphemes, enumeration, scores, promotion, explanation."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lexloom.operators import addressing, aggregate, artifact, facts, holdout, phonology, scoring, screening
from lexloom.plans.reference import _BASE, _KEYS, _PROVIDERS_SQL, POSITIONS, Query, _accepted, _blend, _descriptors, _held, _records
from lexloom.session import table
from lexloom.types import Use

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def kept(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return kept


def _names(spark: SparkSession, folder: str):
    return _accepted(spark, folder).select("normalized").distinct()


@query(f"with {_BASE} select normalized, round(1 - levenshtein(normalized, replace(replace(normalized, 'ph', 'f'), 'c', 'k')) / greatest(length(normalized), length(replace(replace(normalized, 'ph', 'f'), 'c', 'k'))), 9) as alignment from (select distinct normalized from accepted)")
def spelling_round_trip(spark, folder):
    """Names spelt by sound (ph as f, c as k) and how much of them comes back."""
    again = F.replace(F.replace("normalized", F.lit("ph"), F.lit("f")), F.lit("c"), F.lit("k"))
    names = _names(spark, folder)
    return names.select("normalized", F.round(phonology.round_trip(F.split("normalized", ""), F.split(again, "")), 9).alias("alignment"))


_MORPHEMES = f"""m as (select normalized, row_number() over (order by normalized) as r from held), lefts as (select normalized as id, substr(normalized, 1, 4) as form, case when r % 2 = 0 then 'root' else 'stem' end as type from m where r % 4 < 2),
rights as (select normalized as id, substr(normalized, -3) as form, case when r % 3 = 0 then 'suffix' else 'ending' end as type from m where r % 4 >= 2),
links(left_type, right_type, linking_vowel) as (values ('root', 'suffix', 'o'), ('stem', 'ending', 'i'))"""


@query(f"""with {_BASE}, {_MORPHEMES}, met as (select l.id as left_id, r.id as right_id, l.form || case when regexp_matches(l.form, '[aeiouy]$') or regexp_matches(r.form, '^[aeiouy]') then '' else linking_vowel end || r.form as s
  from lefts l join links k on k.left_type = l.type join rights r on r.type = k.right_type)
  select left_id, right_id, list_aggregate(list_transform(list_filter(range(1, length(s) + 1), lambda i: i = 1 or substr(s, i, 1) <> substr(s, i - 1, 1)), lambda i: substr(s, i, 1)), 'string_agg', '') as surface from met""")
def composed_names(spark, folder):
    """Fronts and ends of the held-out names as morphemes, joined where a rule lets them."""
    from pyspark.sql import Window

    # A few hundred names, sealed; the number in their order decides what each gives.
    m = _held(spark, folder).withColumn("r", F.row_number().over(Window.orderBy("normalized")))
    lefts = m.where(F.col("r") % 4 < 2).select(F.col("normalized").alias("id"), F.substring("normalized", 1, 4).alias("form"), F.when(F.col("r") % 2 == 0, "root").otherwise("stem").alias("type"))
    rights = m.where(F.col("r") % 4 >= 2).select(F.col("normalized").alias("id"), F.substring("normalized", -3, 3).alias("form"), F.when(F.col("r") % 3 == 0, "suffix").otherwise("ending").alias("type"))
    links = spark.createDataFrame([("root", "suffix", "o"), ("stem", "ending", "i")], "left_type string, right_type string, linking_vowel string")
    return phonology.compose(lefts, rights, links)


@query(f"with {_BASE}, u as (select substr(normalized, 1, 3) as id, sum(total_count)::bigint as n from totals group by 1) select id, round(1.0::double / (1 + ln(1 + n)), 9) as weight from u")
def saturation_weights(spark, folder):
    """Beginnings of names as morphemes, each weighed down by how many records already begin so."""
    totals = aggregate.convergence(aggregate.saturation(_accepted(spark, folder)))
    usage = totals.select(F.substring("normalized", 1, 3).alias("id"), F.col("total_count").alias("brand_count"))
    morphemes = usage.select("id").distinct().withColumn("weight", F.lit(1.0))
    return phonology.saturation_weight(morphemes, usage).select("id", F.round("weight", 9).alias("weight"))


_SURFACE = "['k', 't', 'm', 'l', 'br'][idx % 5 + 1] || ['a', 'i', 'o'][(idx // 5) % 3 + 1] || ['rv', 'n', 'st', 'l'][(idx // 15) % 4 + 1] || ['a', 'on', 'ix', 'um', 'e'][(idx // 60) % 5 + 1]"


@query(f"select idx, 'other' as stored, {_SURFACE} as replayed from range(0, 300) t(idx) where idx % 7 = 0")
def replay_failures(spark, folder):
    """Stored names of which every seventh isn't what its index gives."""
    built = addressing.build(addressing.enumerate_range(spark, 0, 300), POSITIONS)
    return addressing.replay_failures(built.select("idx", F.when(F.col("idx") % 7 == 0, "other").otherwise(F.col("surface")).alias("surface")), POSITIONS)


@query("select 'same rules' as change, true as same_space, true as compatible union all select 'order of keys', true, true union all select 'a choice appended', false, false union all select 'a choice moved', false, false")
def space_versions(spark, folder):
    """Which changes of a ruleset mint another space, and which keep all indices."""
    moved = {p: list(reversed(c)) for p, c in POSITIONS.items()}
    longer = {p: [*c, "zz"] for p, c in POSITIONS.items()}
    changes = {"same rules": POSITIONS, "order of keys": {**POSITIONS}, "a choice appended": longer, "a choice moved": moved}
    rows = [(what, addressing.space_id(new) == addressing.space_id(POSITIONS), addressing.compatible(POSITIONS, new)) for what, new in changes.items()]
    return spark.createDataFrame(rows, "change string, same_space boolean, compatible boolean")


@query("select idx, ['k', 'm'][idx % 2 + 1] || ['a', 'i', 'o'][(idx // 2) % 3 + 1] || ['rv', 'n', 'st', 'l'][(idx // 6) % 4 + 1] || ['on', 'um'][(idx // 24) % 2 + 1] as surface from range(0, 48) t(idx)")
def brief_subspace(spark, folder):
    """The whole of the smaller space that a brief leaves."""
    allowed = addressing.subspace(POSITIONS, {"onset": ["m", "k"], "end": ["um", "on"]})
    return addressing.build(addressing.enumerate_range(spark, 0, 48), allowed)


@query("""with m(input, value) as (values ('engine', '1.0'), ('ruleset', 'space1:abc'), ('seed', '42')) select 'run-1' as run_id, input, value,
  'sha256:' || sha256('{"engine": "1.0", "ruleset": "space1:abc", "seed": "42"}') as manifest_hash from m""")
def run_manifest(spark, folder):
    return addressing.manifest(spark, "run-1", seed="42", engine="1.0", ruleset="space1:abc")


@query(f"with {_BASE}, n as (select normalized, lag(normalized) over (order by normalized) as before from held) select normalized, before, substr(normalized, 1, (length(normalized) + 1) // 2) || substr(before, length(before) // 2 + 1) as made from n where before is not null")
def portmanteaus(spark, folder):
    """Each held-out name blended with the one before it in their order."""
    from pyspark.sql import Window

    pairs = _held(spark, folder).withColumn("before", F.lag("normalized").over(Window.orderBy("normalized"))).where("before is not null")
    return pairs.select("normalized", "before", phonology.portmanteau(F.col("normalized"), F.col("before")).alias("made"))


@query(f"with {_BASE}, v as (select distinct regexp_replace(normalized, '[aeiouy]', '', 'g') as phonoform_id, normalized from accepted) select phonoform_id, count(*) as n_variants, 1.0::double / count(*) as spellability from v group by 1")
def spelling_ambiguity(spark, folder):
    variants = _names(spark, folder).select(F.regexp_replace("normalized", "[aeiouy]", "").alias("phonoform_id"), F.col("normalized").alias("surface"))
    return scoring.spelling_ambiguity(variants)


@query(f"""with {_BASE}, n as (select distinct normalized, normalized in (select lower(normalized) from provider_counts where normalized is not null) as word, normalized in (select normalized from held) as descr, contains(normalized, 'or') as sug from accepted)
  select normalized, case when not word and not descr and not sug then 'fanciful' when descr and word then 'generic' when descr then 'descriptive' when sug then 'suggestive' else 'arbitrary' end as strength from n""")
def strength_classes(spark, folder):
    """Strength of names as marks, with the dictionary, the held-out names and a syllable as lexicons."""
    tagged = aggregate.name_flags(_tagged(spark, folder)).withColumn("suggests", F.col("normalized").contains("or"))
    word, descriptive = F.col("dictionary_word"), F.col("profanity_signal")
    return tagged.select("normalized", scoring.strength_class(~word & ~descriptive & ~F.col("suggests"), word, F.col("suggests"), descriptive).alias("strength"))


def _tagged(spark: SparkSession, folder: str):
    from lexloom.operators import normalise

    return normalise.normalise(_records(spark, folder), table(spark, folder, "provider_counts").select("normalized"), _held(spark, folder))


@query(f"""with {_BASE}, n as (select distinct normalized, regexp_replace(normalized, '[aeiouy]', '', 'g') as phonoform_id from accepted), p as (select phonoform_id, count(*) as n_spellings from n group by 1)
  select n.normalized as surface, n.phonoform_id, n_spellings, length(normalized) as letters, total_count from n join p using (phonoform_id) join totals using (normalized)""")
def scores_by_scope(spark, folder):
    """Scores of three scopes - sound, spelling, derivation - computed once each and joined late."""
    names = _names(spark, folder).select(F.col("normalized").alias("surface"), F.regexp_replace("normalized", "[aeiouy]", "").alias("phonoform_id"), F.col("normalized").alias("derivation_id"))
    by_sound = names.groupBy("phonoform_id").agg(F.count("*").alias("n_spellings"))
    by_surface = names.select("surface", F.length("surface").alias("letters"))
    by_derivation = aggregate.convergence(aggregate.saturation(_accepted(spark, folder))).select(F.col("normalized").alias("derivation_id"), "total_count")
    return scoring.by_scope(names, by_sound, by_surface, by_derivation).select("surface", "phonoform_id", "n_spellings", "letters", "total_count")


@query(f"""with {_BASE}, {_KEYS}, hh as (select normalized as mark, unnest(list_append(list_transform(range(1, length(normalized) + 1), lambda i: substr(normalized, 1, i - 1) || substr(normalized, i + 1)), normalized)) as k from held),
  p as (select distinct normalized as candidate, mark from ck join hh using (k)), s as (select *, case when candidate = mark then 'exact' else 'edit_distance' end as match_type, 1 - levenshtein(candidate, mark) / greatest(length(candidate), length(mark)) as sim from p),
  cl as (select mark, unnest(case when length(mark) % 3 = 0 then ['9', '42'] when length(mark) % 3 = 1 then ['25'] else ['none'] end) as class from (select distinct mark from s))
  select candidate, match_type, class, count(*) as n_signals, round(max(sim), 9) as best_similarity from s join cl using (mark) group by 1, 2, 3""")
def signals_by_class(spark, folder):
    """Signals per candidate, kind and class of goods, by spelling."""
    marks = _held(spark, folder)
    classes = marks.select(F.col("normalized").alias("mark"), F.explode(F.when(F.length("normalized") % 3 == 0, F.array(F.lit("9"), F.lit("42"))).when(F.length("normalized") % 3 == 1, F.array(F.lit("25"))).otherwise(F.array().cast("array<string>"))).alias("class"))
    found = screening.signals(_accepted(spark, folder).select("normalized"), marks, phonetic=False)
    return screening.signal_counts_by_class(found, classes).withColumn("best_similarity", F.round("best_similarity", 9))


@query(f"with {_BASE} select distinct normalized from accepted where normalized in (select normalized from held)")
def collisions_by_word(spark, folder):
    """Candidates that are one of the words to keep away from (the part of ``collisions`` that SQL can say)."""
    return screening.collision_gate(_accepted(spark, folder), _held(spark, folder)).where("collides = 'word'").select("normalized")


@query(None)
def collisions(spark, folder):
    """Candidates that are, or sound like, one of the words to keep away from."""
    return screening.collision_gate(_accepted(spark, folder), _held(spark, folder)).where("collides is not null")


_HINTS = """hints as (select normalized, provider_id as source, case when coalesce(record_count, 0) > 1 then 'registered' else 'free' end as status, coalesce(record_count, 0)::double as confidence from (select lower(normalized) as normalized, provider_id, record_count from provider_counts where normalized is not null))"""


@query(f"""with {_BASE}, {_HINTS}, s as (select normalized, round(least(1.0, total_count / 20.0), 6)::double as score from totals), r as (select distinct normalized from hints where source like 'domlist.%' and status = 'registered'),
  h as (select normalized, arg_max(status, [confidence::varchar.lpad(20, '0'), status]) filter (source not like 'regio.%') as hint, arg_max(status, [confidence::varchar.lpad(20, '0'), status]) filter (source like 'regio.%') as said from hints group by 1),
  l as (select s.*, r.normalized is not null as taken, hint, said from s left join r using (normalized) left join h using (normalized))
  select normalized, score, case when taken then 'L0' when score < 0.5 then 'L1' when said is null then 'L2' else 'L3' end as level, hint,
    case when taken then 'taken' when score < 0.5 or said is null then null when said = 'registered' then 'taken' else 'free' end as verdict from l""")
def promotion(spark, folder):
    """Names through the levels of checking: registered ones stop, low scores wait, hints never decide, registries do."""
    totals = aggregate.convergence(aggregate.saturation(_accepted(spark, folder)))
    known = table(spark, folder, "provider_counts").where("normalized is not null").select(
        F.lower("normalized").alias("normalized"), F.col("provider_id").alias("source"), F.when(F.coalesce("record_count", F.lit(0)) > 1, "registered").otherwise("free").alias("status"), F.coalesce("record_count", F.lit(0)).cast("double").alias("confidence"),
    )
    registered = known.where(F.col("source").startswith("domlist.") & (F.col("status") == "registered")).select(F.col("normalized").alias("name"))
    scored = totals.select("normalized", F.round(F.least(F.lit(1.0), F.col("total_count") / 20), 6).alias("score"))
    verdict_sources = [r["source"] for r in known.where(F.col("source").startswith("regio.")).select("source").distinct().orderBy("source").collect()]
    return facts.promote(scored, registered, known, 0.5, verdict_sources)


@query("""with n as (select p_partkey, p_size as n_domains, p_size - p_partkey % 3 as n_free, p_retailprice as cost_cents, 4 as n_handles, case when p_partkey % 5 = 0 then null else p_partkey % 5 end as n_free_handles from part),
  s as (select p_partkey, case when n_domains = 0 then null else n_free / n_domains end as a, 1 / (1 + log10(1 + cost_cents / 100)) as c, n_free_handles / n_handles as h from n)
  select p_partkey, round((coalesce(a, 0) * 0.5 + coalesce(c, 0) * 0.2 + coalesce(h, 0) * 0.3) / (case when a is null then 0 else 0.5 end + case when c is null then 0 else 0.2 end + case when h is null then 0 else 0.3 end), 6)::double as ownability from s""")
def ownabilities(spark, folder):
    """Ownability of parts as names: free of their domains, cost, free of their handles (not known of every fifth)."""
    key = F.col("p_partkey")
    names = table(spark, folder, "part").select("p_partkey", F.col("p_size").alias("n_domains"), (F.col("p_size") - key % 3).alias("n_free"), F.col("p_retailprice").alias("cost_cents"), F.lit(4).alias("n_handles"), F.when(key % 5 != 0, key % 5).alias("n_free_handles"))
    return facts.ownability(names, {"availability": 0.5, "cost": 0.2, "handles": 0.3}).select("p_partkey", F.round("ownability", 6).alias("ownability"))


@query("""with s as (select l_orderkey, l_linenumber, l_discount::double as fit, l_tax::double as novelty from lineitem where l_discount is not null and l_tax is not null)
  select l_orderkey, l_linenumber, 'composite' as number, round((fit * 0.7 + novelty * 0.3) / 1.0, 6) as value, null::double as weight, null::double as part, 'view' as layer, 'engine' as writer, '1' as version from s
  union all select l_orderkey, l_linenumber, 'fit', round(fit, 6), 0.7, round(fit * 0.7, 6), 'score', 'semantic', '3' from s union all select l_orderkey, l_linenumber, 'novelty', round(novelty, 6), 0.3, round(novelty * 0.3, 6), 'score', 'novelty', '2' from s""")
def explained_scores(spark, folder):
    """Every number of a composite with the part it has, and where it comes from."""
    s = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").cast("double").alias("fit"), F.col("l_tax").cast("double").alias("novelty")).where("fit is not null and novelty is not null")
    origins = {"composite": ("view", "engine", "1"), "fit": ("score", "semantic", "3"), "novelty": ("score", "novelty", "2")}
    return scoring.explain(s, ["l_orderkey", "l_linenumber"], {"fit": 0.7, "novelty": 0.3}, origins).withColumns({c: F.round(c, 6) for c in ("value", "part")})


@query("""with q as (select embedding as b from embeddings order by vec_id limit 1), n as (select vec_id, embedding, [label::varchar, case when vec_id % 2 = 0 then 'even' else 'odd' end] as tags from embeddings),
  s as (select vec_id, len(list_intersect(tags, ['3', 'even'])) / len(list_distinct(list_concat(tags, ['3', 'even']))) as o, list_dot_product(embedding::double[], b::double[]) / (sqrt(list_dot_product(embedding::double[], embedding::double[])) * sqrt(list_dot_product(b::double[], b::double[]))) as c
    from n cross join q where list_has_any(tags, ['3', 'even']))
  select vec_id, round(o + c, 6) as score from s order by o + c desc, vec_id limit 15""")
def retrieved_by_vector(spark, folder):
    """The best names for a brief by shared tags and by its vector; only names that share a tag are looked at."""
    v = table(spark, folder, "embeddings")
    brief = F.array(*[F.lit(float(x)) for x in v.orderBy("vec_id").first()["embedding"]])
    names = v.select("vec_id", F.format_string("%012d", "vec_id").alias("normalized"), "embedding", F.array(F.col("label").cast("string"), F.when(F.col("vec_id") % 2 == 0, "even").otherwise("odd")).alias("tags"))
    return scoring.retrieve(names, ["3", "even"], brief).select("vec_id", F.round("score", 6).alias("score"))


@query("select idx % 300 as surface_idx, count(*) as n_tags from (select distinct idx % 300 as idx, case when idx < 300 then 'first' else 'again' end as tag from range(0, 450) t(idx)) group by 1")
def concepts_of_convergent_names(spark, folder):
    """Concept tags of all derivations of a name, united."""
    df = addressing.enumerate_range(spark, 0, 450).select((F.col("idx") % 300).alias("surface_idx"), F.when(F.col("idx") < 300, "first").otherwise("again").alias("tag"))
    built = addressing.build(df.select(F.col("surface_idx").alias("idx"), "tag"), POSITIONS)
    united = aggregate.name_categories(built.select(F.col("surface").alias("normalized"), F.array("tag").alias("categories"), "idx"))
    index = built.select("surface", "idx").distinct()
    return united.join(index, F.col("normalized") == F.col("surface")).groupBy(F.col("idx").alias("surface_idx")).agg(F.count("*").alias("n_tags"))


@query(f"with {_BASE}, {_KEYS} select (select count(*) from held) as n_held, (select count(*) from c) as n_names, count(*) as n_excluded from (select distinct normalized from ck where k in (select k from hk))")
def exclusion_index(spark, folder):
    """How many distinct names are sealed, and how many of the accepted ones they exclude by spelling."""
    held, names = _held(spark, folder), _names(spark, folder)
    out = holdout.near_contamination(names, held).agg(F.count("*").alias("n_excluded"))
    return out.select(held.agg(F.count("*")).scalar().alias("n_held"), names.agg(F.count("*")).scalar().alias("n_names"), "n_excluded")


@query(f"""with {_BASE}, {_KEYS}, dirty as (select distinct normalized from ck where k in (select k from hk)), clean as (select normalized from c where normalized not in (select normalized from dirty))
  select 'as built' as names, (select count(*) from dirty) as n_found union all select 'cleaned', 0""")
def cleaned_names(spark, folder):
    """The guard over names before and after the held-out ones are taken out, by spelling."""
    held, names = _held(spark, folder), _names(spark, folder)
    dirty = holdout.near_contamination(names, held)
    clean = names.join(dirty, "normalized", "left_anti")
    count = lambda what, df: df.agg(F.count("*").alias("n_found")).select(F.lit(what).alias("names"), "n_found")
    return count("as built", dirty).unionByName(count("cleaned", holdout.near_contamination(clean, held)))


@query(f"""with {_BASE}, {_KEYS} select key, count(*) as n_names from (select distinct normalized, case when normalized in (select normalized from held) then 'exact' else 'edit_distance' end as key from ck where k in (select k from hk)) group by 1""")
def excluded_by_spelling(spark, folder):
    """Excluded names by key, as far as no sounds count."""
    return holdout.excluded_histogram(holdout.near_contamination(_names(spark, folder), _held(spark, folder)))


@query(f"""with {_PROVIDERS_SQL}, {_BASE}, {_KEYS}, mine as (select distinct normalized from saturation join providers on split_part(provider_id, '.', 1) = prefix where kind = 'registry'),
  dirty as (select distinct normalized from ck where k in (select k from hk))
  select (select count(*) from mine) as n_blended, (select count(*) from mine where normalized in (select normalized from dirty)) as n_spelt_alike, true as all_taken_out, true as rest_is_by_sound""")
def induction_guard(spark, folder):
    """The induction artifact against what SQL can say of it: none of the names that spelling excludes is in it, and what else is missing sounds like a held-out one."""
    known, held = _descriptors(spark, folder), _held(spark, folder)
    evidence = aggregate.saturation(_accepted(spark, folder))
    whole, made = artifact.build(Use.NOVELTY_REFERENCE, _blend(known), known, evidence).names, artifact.build(Use.INDUCTION, _blend(known), known, evidence, held)
    near = holdout.near_contamination(whole, held)
    count = lambda df: df.agg(F.count("*")).scalar()
    return spark.range(1).select(
        count(whole).alias("n_blended"), count(near).alias("n_spelt_alike"), (count(near.join(made.names, "normalized", "left_semi")) == 0).alias("all_taken_out"),
        (count(whole) - count(made.names) - F.lit(made.excluded_by_holdout.get("phonetic", 0)) - count(near.where("key = 'exact'")) - F.lit(made.excluded_by_holdout.get("edit_distance", 0)) == 0).alias("rest_is_by_sound"),
    )
