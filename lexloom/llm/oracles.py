"""The same queries as DuckDB SQL, where SQL can express them over whole tables."""

from __future__ import annotations

#: Full-width letters and digits and their plain forms: the compatibility forms strip_accents leaves alone.
_WIDE = "".join(chr(c) for r in ((0xFF10, 0xFF1A), (0xFF21, 0xFF3B), (0xFF41, 0xFF5B)) for c in range(*r))
_PLAIN = "".join(chr(ord(c) - 0xFEE0) for c in _WIDE)


def _key(column: str) -> str:
    return f"regexp_replace(lower(strip_accents(replace(translate({column}, '{_WIDE}', '{_PLAIN}'), '™', 'TM'))), '[^a-z0-9]+', '', 'g')"


def _letters(column: str) -> str:
    return rf"regexp_replace(lower({column}), '[^\p{{L}}\p{{M}}\p{{N}}]+', '', 'g')"


def _list(column: str) -> str:
    return f"list_sort(list_transform({column}, lambda x: coalesce({_letters('x')}, chr(1))))"


_COUNTS = f"""
with counts as (
  select 'normalised_record' as table_name, {_key('normalized')} as term, count(*) as occurrences, count(*) as records
  from normalised_record group by 2
  union all
  select 'provider_counts', {_key('normalized')}, sum(coalesce(record_count, 0)), count(*)
  from (select distinct * from provider_counts) group by 2
), kept as (select * from counts where term <> ''), marked as (
  select table_name, term, occurrences::bigint as occurrences, records::bigint as records,
    case when occurrences <= 2 then 'rare' when occurrences * 50 >= sum(occurrences) over (partition by table_name) then 'common' end as verdict
  from kept where term is not null
)
"""

_COPIES = f"""
with a as (
  select 'corpus_record' as table_name, record_id as id, to_json([{_letters('text')}, {_letters('provider_id')}, {_letters('source_ref')}, {_letters('status')}, first_seen_year::varchar, {_letters('vintage')}])::varchar
    || '|' || coalesce(to_json({_list('categories')})::varchar, 'null') || '|' || coalesce(to_json(list_sort(list_transform(map_entries(source_fields),
      lambda e: {_letters('e.key')} || '=' || coalesce({_letters('e.value')}, chr(1)))))::varchar, 'null') as fields
  from corpus_record
  union all
  select 'normalised_record', norm_id, to_json([{_letters('normalized')}, {_letters('display')}, {_letters('provider_id')}, {_letters('source_ref')}, {_letters('status')}, first_seen_year::varchar])::varchar
    || '|' || coalesce(to_json({_list('tags')})::varchar, 'null') || '|' || coalesce(to_json({_list('categories')})::varchar, 'null')
  from normalised_record
), g as (select table_name, id, min(id) over (partition by table_name, fields) as first_id, count(*) over (partition by table_name, fields) as n_copies from a)
"""

_OVERLAPS = f"""
with h as (select holdout_id, split_name, source_name, {_key('name_line')} as k from holdout_names),
t as (
  select 'normalised_record' as found_in, norm_id::varchar as found_key, {_key('normalized')} as k from normalised_record
  union select distinct 'corpus_artifact', artifact_id, {_key('n')} from (select artifact_id, unnest(names) as n from corpus_artifact)
), pairs as (
  select h.holdout_id, h.split_name, h.source_name, h.k as hk, d.k as tk from h join (select distinct k from t where k <> '') d
  on h.k <> '' and (h.k = d.k or (length(h.k) >= 5 and abs(length(h.k) - length(d.k)) <= 1 and damerau_levenshtein(h.k, d.k) <= 1))
), found as (
  select holdout_id, coalesce(split_name, 'unknown') as split_name, coalesce(source_name, 'unknown') as source_name, found_in, found_key,
    max(case when hk = tk then 'exact' else 'almost' end) as match
  from pairs join t on t.k = pairs.tk group by all
)
"""

_LEAKS = r"""
with d as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from documents where text is not null),
i as (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from eval_items where text is not null),
ig as (select distinct item_id, list_aggregate(w[k:k + 11], 'string_agg', ' ') as g from (select item_id, w, unnest(range(1, len(w) - 10)) as k from i where len(w) >= 12)),
dg as (select distinct doc_id, list_aggregate(w[k:k + 11], 'string_agg', ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 10)) as k from d where len(w) >= 12)),
found as (select distinct doc_id, item_id from dg join ig using (g))
"""

ORACLES = {
    "p2_found": _COUNTS + "select table_name, term, verdict from marked where verdict is not null",
    "p2_term_counts": _COUNTS + "select table_name, term, occurrences, records, coalesce(verdict, 'useful') as verdict from marked",
    "p2_incremental": _COUNTS + "select table_name, term, occurrences, records from marked",
    "p3_found": _COPIES + "select table_name, first_id, id as copy_id from g where id <> first_id",
    "p3_collapsed_names": _COPIES + "select norm_id, normalized, display, provider_id, source_ref, n_copies from g join normalised_record on id = norm_id where table_name = 'normalised_record' and id = first_id",
    "p5_found": _OVERLAPS + "select holdout_id, found_in, found_key from found",
    "p5_per_split": _OVERLAPS + "select split_name, source_name, found_in, match, count(distinct holdout_id) as n_held_out, count(*) as n_overlaps from found group by all",
    "p5_artifact_claims": _OVERLAPS + """select artifact_id, use_kind, case when excluded_by_holdout is not null then coalesce(list_sum(list_transform(map_values(excluded_by_holdout), lambda x: coalesce(x, 0))), 0)::bigint end as n_claimed, coalesce(n, 0) as n_found
      from corpus_artifact left join (select found_key as artifact_id, count(distinct holdout_id) as n from found where found_in = 'corpus_artifact' group by 1) using (artifact_id)""",
    "p6_found": _LEAKS + "select doc_id, item_id from found",
    "p6_items": _LEAKS + r""", dp as (select doc_id, k, list_aggregate(w[k:k + 11], 'string_agg', ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 10)) as k from d where len(w) >= 12)),
      ip as (select item_id, k, list_aggregate(w[k:k + 11], 'string_agg', ' ') as g from (select item_id, w, unnest(range(1, len(w) - 10)) as k from i where len(w) >= 12)),
      met as (select doc_id, item_id, dp.k as place, dp.k - ip.k as line, dp.k - row_number() over (partition by doc_id, item_id, dp.k - ip.k order by dp.k) as island from dp join ip using (g)),
      runs as (select doc_id, item_id, count(*) + 11 as n from met group by doc_id, item_id, line, island),
      per_item as (select item_id, count(distinct doc_id) as n_documents, max(n)::int as longest_words from runs group by 1)
      select item_id, benchmark, split_name, coalesce(n_documents, 0) as n_documents, longest_words from eval_items left join per_item using (item_id)""",
    "p6_clean_documents": _LEAKS + "select doc_id, source, lang, n_chars from documents where doc_id not in (select doc_id from found)",
    "p7_invariants": """select unnest(['quota met to within a document', 'document used no more than allowed', 'no copy of a document twice', 'no copy of a block twice', 'shards alike in blocks',
      'blocks of shards as the tree says', 'places without gaps']) as rule, 0::bigint as n_violations""",
    "p7_plan_in_words": """with w as (select source, len(regexp_extract_all(text, '[A-Za-z]+')) as n from documents), s as (select source, sum(coalesce(n, 0))::bigint as n from w group by 1),
      p as (select t.source, coalesce(n, 0) as size_tokens, target_share, max_repeats, max_repeats * coalesce(n, 0) as most_tokens,
        ceil(target_share::decimal(12, 9) * (select sum(n)::bigint from s))::bigint as target_tokens from mix_targets t left join s using (source))
      select *, least(target_tokens, most_tokens) as quota_tokens from p""",
    "p8_invariants": """select unnest(['every document has a row', 'levels lie within the bands', 'the band is the nearest', 'shares add up', 'no level without words',
      'a level wherever there are sentences']) as rule, 0::bigint as n_violations""",
    # Sizes in characters instead of tokens: the answer is the same in any usual unit.
    "p7_found": """select t.source from mix_targets t left join (select source, sum(length(text)) as n from documents group by 1) s using (source)
      where t.max_repeats * coalesce(s.n, 0) < t.target_share * (select sum(length(text)) from documents)""",
}
