"""Queries of the general problems: changes between snapshots, and drifting schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.operators import snapshot_diff
from lexloom.session import table
from lexloom.sources.one_table import OneTable
from lexloom.sources.schema_drift import NO, YES, Drift


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot_diff.corpus_changes(table(spark, folder, "corpus_record"), table(spark, folder, "snapshot_ledger"))


def p1_change_counts(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot_diff.change_counts(p1_found(spark, folder))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return Drift(table(spark, folder, "case_file_lines")).changes()


def p4_unified(spark: SparkSession, folder: str) -> DataFrame:
    return OneTable(Drift(table(spark, folder, "case_file_lines"))).lines()


def p4_steps(spark: SparkSession, folder: str) -> DataFrame:
    return Drift(table(spark, folder, "case_file_lines")).steps()


def p4_cell_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What ``p4_unified`` holds of every file: its lines that fit and their cells, wherever these stand."""
    return OneTable(Drift(table(spark, folder, "case_file_lines"))).cell_counts()


def p4_families(spark: SparkSession, folder: str) -> DataFrame:
    """The column of the one table that every file's column goes to, and the type it has there."""
    one = OneTable(Drift(table(spark, folder, "case_file_lines")))
    types = spark.createDataFrame(one.families, "family string, type string")
    held = one.layout.select("feed_id", "file_no", F.posexplode("columns").alias("at", "c")).where(F.col("c").isNotNull())
    found = held.join(F.broadcast(types.withColumn("at", F.row_number().over(Window.orderBy("family")) - 1)), "at").select("feed_id", "file_no", F.col("c.name").alias("name"), "family", "type")
    if not one.rarer:
        return found
    return found.unionByName(one.layout.select("feed_id", "file_no", F.inline("rarer")).select("feed_id", "file_no", "name", "family", F.col("kind").alias("type")))


def p4_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of every file with their types."""
    drift = Drift(table(spark, folder, "case_file_lines"))
    return drift.profile.select("feed_id", "file_no", "name", F.coalesce("kind", F.lit("none")).alias("kind"), "n_values")


QUERIES = {"p1_found": p1_found, "p1_change_counts": p1_change_counts, "p4_found": p4_found, "p4_unified": p4_unified, "p4_columns": p4_columns, "p4_steps": p4_steps, "p4_cell_counts": p4_cell_counts, "p4_families": p4_families}

_CHANGES = """
with steps as (
  select provider_id, vintage, row_number() over (partition by provider_id order by min(ledger_seq)) as step
  from snapshot_ledger group by 1, 2
), rows_ as (
  select r.provider_id, lower(trim(source_ref)) as source_ref, step, arg_max(coalesce(lower(trim(status)), 'unknown'), loaded_at) as status
  from corpus_record r join steps s on r.provider_id = s.provider_id and r.vintage = s.vintage
  where source_ref is not null group by 1, 2, 3
), later as (select * from rows_ where step > 1),
earlier as (select r.provider_id, source_ref, r.step + 1 as step, status from rows_ r join steps s on s.provider_id = r.provider_id and s.step = r.step + 1),
changes as (
  select coalesce(l.provider_id, e.provider_id) as provider_id, coalesce(l.source_ref, e.source_ref) as source_ref, coalesce(l.step, e.step) as step,
    case when e.step is null then 'added' when l.step is null then 'removed' when l.status <> e.status then 'changed' end as change_kind
  from later l full join earlier e on l.provider_id = e.provider_id and l.source_ref = e.source_ref and l.step = e.step
), named as (select provider_id, source_ref, vintage, change_kind from changes join steps using (provider_id, step) where change_kind is not null)
"""

_SEPARATORS = (",", ";", "|", "\\t")
_FIELDS = " ".join(
    f"""when separator = E'{s}' then case when contains(raw, '"') then regexp_extract_all(E'{s}' || raw, '{at}(\\s*"(?:[^"]|"")*"\\s*|[^{at}]*)', 1) else string_split(raw, E'{s}') end"""
    for s, at in zip(_SEPARATORS, (",", ";", "\\|", "\\t"), strict=True)
)
_NAME = r"trim(regexp_replace(lower(replace({}, '\"', '')), '[^a-z0-9]+', '_', 'g'), '_')"
#: Every cell of a line that fits its file: (feed_id, file_no, line_id, name, value), missing values as null; and the files' columns.
_CELLS = f"""
with raw_ as (select feed_id, file_no, file_format, line_no, ltrim(raw, chr(65279)) as raw, min(line_id) as line_id from case_file_lines where feed_id is not null and file_no is not null and raw is not null group by all),
heads as (select feed_id, file_no, min(raw) as header from raw_ where file_format = 'delimited' and line_no = 0 group by 1, 2),
marked as (select *, arg_max(s, [length(header) - length(replace(header, s, '')), ascii(s)]) as separator from (select *, unnest([{', '.join(f"E'{s}'" for s in _SEPARATORS)}]) as s from heads) group by feed_id, file_no, header, s),
sep as (select feed_id, file_no, header, arg_max(separator, [length(header) - length(replace(header, separator, '')), ascii(separator)]) as separator from marked group by 1, 2, 3),
cut as (select r.feed_id, r.file_no, r.line_id, r.raw, h.header, case {_FIELDS} end as fields, case {_FIELDS.replace('raw', 'header')} end as names from raw_ r join sep h using (feed_id, file_no) where file_format = 'delimited' and line_no > 0),
objects as (select feed_id, file_no, line_id, try_cast(raw as json) as doc, file_format from raw_ where file_format <> 'delimited'),
found as (
  select feed_id, file_no, line_id, {_NAME.format('unnest(names)')} as name, unnest(fields) as text, 'delimited' as form from cut where len(fields) = len(names)
  union all select feed_id, file_no, line_id, {_NAME.format('k')}, doc ->> concat('$."', k, '"'), 'jsonl' from (select *, unnest(json_keys(doc)) as k from objects where json_type(doc) = 'OBJECT')
), bare as (select * exclude (text), trim(replace(trim(trim(text), '"'), '""', '"')) as value from found),
cells as (select feed_id, file_no, line_id, name, form, case when upper(value) not in ('', 'NULL', 'N/A', chr(92) || 'N', '-') then value end as value from bare)
"""
_TIME = r"[t ]+\d{1,2}:\d{2}(:\d{2})?(\.\d+)?( ?[ap]m)?(z|[+-]\d{2}:?\d{2})?"
_MONTH = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
_DATE = rf"(\d{{4}}[-/.]\d{{1,2}}[-/.]\d{{1,2}}|\d{{1,2}}[-/.]\d{{1,2}}[-/.]\d{{4}}|\d{{1,2}}[ -]{_MONTH}[ ,-]+\d{{4}}|{_MONTH} \d{{1,2}},? \d{{4}})"
_KINDS = f"""case when regexp_full_match(value, '[0-9]+') then 'integer' when lower(value) in ('true', 'false') then 'boolean' when regexp_full_match(value, '[+-]?[0-9]*[.][0-9]+') then 'decimal'
  when regexp_full_match(lower(value), '{_DATE}') then 'date' when regexp_full_match(lower(value), '{_DATE}{_TIME}') then 'timestamp' when value is not null then 'text' end"""
_PROFILE = f""", kinds as (select feed_id, file_no, name, {_KINDS} as kind, count(*) as n, count(value) as k from cells group by 1, 2, 3, 4),
lines_ as (select feed_id, file_no, count(*) - count(*) filter (file_format = 'delimited' and line_no = 0) as n_lines, max(file_format) as form from raw_ group by 1, 2),
sums as (select feed_id, file_no, name, sum(n) as n_with, sum(k)::bigint as n_values from kinds group by 1, 2, 3),
usual as (select feed_id, file_no, name, kind from kinds join sums using (feed_id, file_no, name) where kind is not null and n * 2 > n_values),
columns_ as (select p.feed_id, p.file_no, p.name, u.kind, n_values from sums p join lines_ l using (feed_id, file_no) left join usual u using (feed_id, file_no, name) where form = 'delimited' or n_with * 2 >= n_lines)
"""
_DAY = r"(1[6-9]|2[0-9])\d\d(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])"
_WORDS = lambda words: ", ".join(f"'{w}'" for w in words)
_MONTH_NO = "lpad(list_position(['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'], {})::varchar, 2, '0')"


def _meaning(v: str) -> str:
    """What a value may mean, as a list: days, numbers, flags or letters."""
    low, part = f"lower({v})", lambda pattern, k: f"regexp_extract(lower({v}), '{pattern}', {k})"
    day = lambda y, m, d: f"lpad({y}, 4, '0') || lpad({m}, 2, '0') || lpad({d}, 2, '0')"
    days = lambda *of: "list_transform(list_filter([" + ", ".join(of) + f"], lambda x: regexp_full_match(x, '{_DAY}')), lambda x: 'd:' || x)"
    iso, small = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})([t ].*)?$", r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})([t ].*)?$"
    worded, american = rf"^(\d{{1,2}})[ -]{_MONTH}[ ,-]+(\d{{4}})([t ].*)?$", rf"^{_MONTH} (\d{{1,2}}),? (\d{{4}})([t ].*)?$"
    number = r"^[a-z]{0,4}[ _-]?0*(\d+?)(?:\.(\d*?)0*)?(?:[ _-]?[a-z]{0,4})$"
    letters = f"['t:' || regexp_replace(strip_accents({low}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')]"
    return f"""case when regexp_full_match({low}, '[0-9]+') then list_filter(['n:' || case when ltrim({low}, '0') = '' then '0' else ltrim({low}, '0') end, case when regexp_full_match({low}, '{_DAY}') then 'd:' || {low} end,
        case when {low} in ('0', '1') then 'b:' || {low} end], lambda x: x is not null)
      when not regexp_matches({low}, '[0-9]') then case when {low} in ({_WORDS(w for w in YES if w != '1')}) then ['b:1'] when {low} in ({_WORDS(w for w in NO if w != '0')}) then ['b:0'] else {letters} end
      when regexp_matches({low}, '{iso}') then {days(day(part(iso, 1), part(iso, 2), part(iso, 3)))}
      when regexp_matches({low}, '{small}') then {days(day(part(small, 3), part(small, 1), part(small, 2)), day(part(small, 3), part(small, 2), part(small, 1)))}
      when regexp_matches({low}, '{worded}') then {days(day(part(worded, 3), _MONTH_NO.format(part(worded, 2)), part(worded, 1)))}
      when regexp_matches({low}, '{american}') then {days(day(part(american, 3), _MONTH_NO.format(part(american, 1)), part(american, 2)))}
      when regexp_matches({low}, '{number}') then ['n:' || {part(number, 1)} || case when {part(number, 2)} <> '' then '.' || {part(number, 2)} else '' end] else {letters} end"""


_CHANGES_4 = f""", serial_like as (select feed_id, file_no, name, count(*) filter (s) * least(1, count(distinct value) filter (s) / greatest(count(value), 1)) as score
    from (select *, coalesce(regexp_full_match(value, '\\d{{6,}}') and not regexp_full_match(value, '{_DAY}'), false) as s from cells) group by 1, 2, 3),
  serials as (select feed_id, file_no, arg_max(name, [lpad((coalesce(score, 0) * 1000)::bigint::varchar, 18, '0'), name]) as serial from serial_like join columns_ using (feed_id, file_no, name) group by 1, 2),
  lined as (select c.feed_id, c.file_no, c.line_id, regexp_replace(c.value, '\\.0+$', '') as sv from cells c join serials s on s.feed_id = c.feed_id and s.file_no = c.file_no and s.serial = c.name where regexp_full_match(regexp_replace(c.value, '\\.0+$', ''), '\\d+')),
  files as (select feed_id, file_no, lag(file_no) over (partition by feed_id order by file_no) as before from (select distinct feed_id, file_no from columns_)),
  gone as (select f.feed_id, f.file_no, f.before, o.name from files f join columns_ o on o.feed_id = f.feed_id and o.file_no = f.before left join columns_ n on n.feed_id = f.feed_id and n.file_no = f.file_no and n.name = o.name where n.name is null),
  fresh as (select f.feed_id, f.file_no, n.name from files f join columns_ n using (feed_id, file_no) left join columns_ o on o.feed_id = f.feed_id and o.file_no = f.before and o.name = n.name where f.before is not null and o.name is null),
  side as (select c.feed_id, c.file_no, sv, c.name, max(c.value) as value from cells c join lined using (feed_id, file_no, line_id) where c.value is not null group by 1, 2, 3, 4),
  olds as (select g.feed_id, g.file_no, g.name, sv, value, {_meaning('value')} as k from gone g join side s on s.feed_id = g.feed_id and s.file_no = g.before and s.name = g.name),
  news as (select g.feed_id, g.file_no, g.name, sv, value, {_meaning('value')} as k from fresh g join side s on s.feed_id = g.feed_id and s.file_no = g.file_no and s.name = g.name),
  met as (select feed_id, file_no, o.name as old_name, n.name as new_name, list_has_any(o.k, n.k) as same, list_contains(o.k, 'b:1') as oy, list_contains(o.k, 'b:0') as ono, list_contains(n.k, 'b:1') as ny, list_contains(n.k, 'b:0') as nno,
    lower(o.value) <> lower(n.value) as other from olds o join news n using (feed_id, file_no, sv)),
  counted as (select feed_id, file_no, old_name, new_name, count(*) as n_both, count(*) filter (same) as n_same, count(*) filter ((oy or ono) and (ny or nno)) as f, count(*) filter (oy and ny or ono and nno) as fs,
    count(*) filter ((oy and ny or ono and nno) and other) as re, count(*) filter (oy and (ny or nno)) as fo, count(*) filter (ny and (oy or ono)) as fn from met group by 1, 2, 3, 4),
  agreed as (select *, fo / f * fn / f + (1 - fo / f) * (1 - fn / f) as chance from counted where n_same * 3 >= n_both * 2),
  standing as (select * from agreed where re * 2 <= n_same or chance >= 0.95 or (fs / f - chance) / (1 - chance) >= 0.4),
  best as (select *, row_number() over (partition by feed_id, file_no, old_name order by n_same / n_both desc, new_name) as i, row_number() over (partition by feed_id, file_no, new_name order by n_same / n_both desc, old_name) as j from standing),
  renamed as (select feed_id, file_no, old_name, new_name from best where i = 1 and j = 1),
  kept as (select f.feed_id, f.file_no, f.before, o.name as old_name, o.name as new_name from files f join columns_ o on o.feed_id = f.feed_id and o.file_no = f.before join columns_ n on n.feed_id = f.feed_id and n.file_no = f.file_no and n.name = o.name
    union all select r.feed_id, r.file_no, before, old_name, new_name from renamed r join files using (feed_id, file_no))
select feed_id, file_no, 'renamed' as change_kind, old_name, new_name from renamed
union all select feed_id, file_no, 'removed', name, '' from gone g where not exists (from renamed r where r.feed_id = g.feed_id and r.file_no = g.file_no and r.old_name = g.name)
union all select feed_id, file_no, 'added', '', name from fresh g where not exists (from renamed r where r.feed_id = g.feed_id and r.file_no = g.file_no and r.new_name = g.name)
union all select k.feed_id, k.file_no, 'retyped', old_name, new_name from kept k join columns_ o on o.feed_id = k.feed_id and o.file_no = k.before and o.name = k.old_name join columns_ n on n.feed_id = k.feed_id and n.file_no = k.file_no and n.name = k.new_name where o.kind <> n.kind
"""

ORACLES = {
    "p4_found": _CELLS + _PROFILE + _CHANGES_4,
    "p4_cell_counts": _CELLS + "select feed_id, file_no, count(distinct line_id) as n_lines, count(value) as n_cells from cells group by 1, 2",
    "p4_columns": _CELLS + _PROFILE + "select feed_id, file_no, name, coalesce(kind, 'none') as kind, n_values from columns_",
    "p4_steps": _CELLS + _PROFILE + """, files as (select feed_id, file_no, lag(file_no) over (partition by feed_id order by file_no) as before from (select distinct feed_id, file_no from columns_)),
      met as (select f.feed_id, f.file_no, o.name as old_name, n.name as new_name, o.kind as old_kind, n.kind as new_kind from files f join columns_ o on o.feed_id = f.feed_id and o.file_no = f.before
        left join columns_ n on n.feed_id = f.feed_id and n.file_no = f.file_no and n.name = o.name),
      fresh as (select f.feed_id, f.file_no, count(*) filter (o.name is null) as n_fresh from files f join columns_ n using (feed_id, file_no) left join columns_ o on o.feed_id = f.feed_id and o.file_no = f.before and o.name = n.name where f.before is not null group by 1, 2)
      select feed_id, file_no, count(*) filter (new_name is null) as n_gone, any_value(n_fresh) as n_fresh, count(new_name) as n_kept, count(*) filter (old_kind <> new_kind) as n_kept_retyped from met join fresh using (feed_id, file_no) group by 1, 2""",
    "p1_found": _CHANGES + "select * from named",
    "p1_change_counts": _CHANGES + "select provider_id, vintage, change_kind, count(*) as n_changes from named group by all",
}
