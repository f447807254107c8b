"""Files whose fields are added, renamed, dropped and retyped over time: one table out of all, and a report of each change.

The values are compared in Spark, cell by cell and in one pass per question; similarity flooding runs on what is left
per pair of files: a graph as wide as the two headers.
"""

from __future__ import annotations

from functools import cached_property

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.text import unaccented
from lexloom.session import broadcast_if_small, materialise, ship
from lexloom.sources.schema_match import one_to_one, rename_scores

SEPARATORS = (",", ";", "|", "\t")
MISSING = ("", "NULL", "N/A", "\\N", "-")
TYPES = ("integer", "decimal", "boolean", "date", "timestamp", "text")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
#: Words that stand for yes and no in other spellings of the same flag.
YES = ("true", "t", "yes", "y", "live", "l", "active", "1")
NO = ("false", "f", "no", "n", "dead", "d", "inactive", "0")
MIN_AGREEMENT = 2 / 3
#: Pairs of files that one task matches.
GRAPHS_PER_TASK = 500

FILE = ["feed_id", "file_no"]
BYTE_ORDER_MARK = "\ufeff"
MONTH = "(" + "|".join(MONTHS) + ")[a-z]*"
TIME = r"[t ]+\d{1,2}:\d{2}(:\d{2})?(\.\d+)?( ?[ap]m)?(z|[+-]\d{2}:?\d{2})?"
DATE = rf"(\d{{4}}[-/.]\d{{1,2}}[-/.]\d{{1,2}}|\d{{1,2}}[-/.]\d{{1,2}}[-/.]\d{{4}}|\d{{1,2}}[ -]{MONTH}[ ,-]+\d{{4}}|{MONTH} \d{{1,2}},? \d{{4}})"


def column_name(c: Column) -> Column:
    """Lower case, each run of other characters than a-z and 0-9 one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def cell_value(c: Column) -> Column:
    """The value without quotes and outer blanks; null for any mark of a missing value."""
    bare = F.trim(F.replace(F.btrim(F.trim(c), F.lit('"')), F.lit('""'), F.lit('"')))
    return F.when(~F.upper(bare).isin(*MISSING), bare)


def value_type(v: Column) -> Column:
    """One of ``TYPES`` for a value that isn't missing."""
    low = F.lower(v)
    return (
        F.when(v.rlike(r"^[0-9]+\z"), "integer")
        .when(low.isin("true", "false"), "boolean")
        .when(~v.rlike("[0-9]"), "text")
        .when(v.rlike(r"^[+-]?[0-9]*\.[0-9]+\z"), "decimal")
        .when(low.rlike(rf"^{DATE}\z"), "date")
        .when(low.rlike(rf"^{DATE}{TIME}\z"), "timestamp")
        .otherwise("text")
    )


def _padded(*parts: Column) -> Column:
    year, month, day = parts
    return F.concat(F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))


def _is_day(ymd: Column) -> Column:
    return ymd.rlike(r"^(1[6-9]|2[0-9])\d\d(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])\z")


def value_keys(v: Column) -> Column:
    """What a value may mean, whatever its form: two values agree if their arrays share an entry.

    Dates by their day (both readings of 03/10/1993), numbers without prefix, suffix, leading and trailing zeros,
    flags by yes and no, anything else by its letters and digits without accents or case.
    """
    low = F.lower(v)
    part = lambda pattern, k: F.regexp_extract(low, pattern, k)
    iso = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})([t ].*)?\z"
    small_first = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})([t ].*)?\z"
    worded = rf"^(\d{{1,2}})[ -]{MONTH}[ ,-]+(\d{{4}})([t ].*)?\z"
    american = rf"^{MONTH} (\d{{1,2}}),? (\d{{4}})([t ].*)?\z"
    month = lambda name: F.lpad(F.array_position(F.array(*map(F.lit, MONTHS)), name).cast("string"), 2, "0")
    day = lambda ymd: F.when(_is_day(ymd), F.concat(F.lit("d:"), ymd))
    number = r"^[a-z]{0,4}[ _-]?0*(\d+?)(?:\.(\d*?)0*)?(?:[ _-]?[a-z]{0,4})\z"
    whole, fraction = part(number, 1), part(number, 2)
    digits = F.ltrim(low, F.lit("0"))
    plain = F.array(F.concat(F.lit("n:"), F.when(digits == "", "0").otherwise(digits)), F.when(F.length(low) == 8, day(low)), F.when(low.isin("0", "1"), F.concat(F.lit("b:"), low)))
    letters = F.regexp_replace(unaccented(low), r"[^\p{L}\p{N}]+", "")
    text = F.array(F.concat(F.lit("t:"), letters))
    flag = F.when(low.isin(*YES), F.array(F.lit("b:1"))).when(low.isin(*NO), F.array(F.lit("b:0")))
    # The usual cases come first and need no pattern of a date.
    keys = (
        F.when(low.rlike(r"^[0-9]+\z"), plain)
        .when(~low.rlike("[0-9]"), F.coalesce(flag, text))
        .when(low.rlike(iso), F.array(day(_padded(part(iso, 1), part(iso, 2), part(iso, 3)))))
        .when(low.rlike(small_first), F.array(
            day(_padded(part(small_first, 3), part(small_first, 1), part(small_first, 2))),
            day(_padded(part(small_first, 3), part(small_first, 2), part(small_first, 1))),
        ))
        .when(low.rlike(worded), F.array(day(_padded(part(worded, 3), month(part(worded, 2)), part(worded, 1)))))
        .when(low.rlike(american), F.array(day(_padded(part(american, 3), month(part(american, 1)), part(american, 2)))))
        .when(low.rlike(number), F.array(F.concat(F.lit("n:"), whole, F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""))))
        .otherwise(text)
    )
    return F.filter(keys, lambda k: k.isNotNull())


def _time_of_day(v: Column) -> Column:
    """Hours, minutes and seconds behind a date, as 22:15:00; null without a time, or with one that this doesn't keep whole.

    Kept are 24-hour times to the second, without zone or in UTC (z).
    """
    time = r"^.*\d[t ]+(\d{1,2}):(\d{2})(?::(\d{2}))?z?\z"
    part = lambda k: F.regexp_extract(F.lower(v), time, k)
    return F.when(part(1) != "", F.concat_ws(":", F.lpad(part(1), 2, "0"), part(2), F.lpad(part(3), 2, "0")))


def _separated(line: Column, separator: str) -> Column:
    """The fields of a line; separators inside double quotes don't count."""
    at = "\\" + separator if separator == "|" else separator
    quoted = F.regexp_extract_all(F.concat(F.lit(separator), line), F.lit(rf'{at}(\s*"(?:[^"]|"")*"\s*(?={at}|\z)|[^{at}]*)'), F.lit(1))
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, at, -1))


def _fields(line: Column, separator: Column) -> Column:
    out = F.when(separator == SEPARATORS[0], _separated(line, SEPARATORS[0]))
    for s in SEPARATORS[1:]:
        out = out.when(separator == s, _separated(line, s))
    return out


def clean_lines(lines: DataFrame) -> DataFrame:
    """Each delivered line once (a line may come twice or late), without a byte order mark."""
    return (
        lines.where(F.col("feed_id").isNotNull() & F.col("file_no").isNotNull() & F.col("raw").isNotNull())
        .groupBy(*FILE, "file_format", "line_no", F.ltrim("raw", F.lit(BYTE_ORDER_MARK)).alias("raw"))
        .agg(F.min("line_id").alias("line_id"))
    )


def headers(lines: DataFrame) -> DataFrame:
    """Separator and column names of every delimited file: (feed_id, file_no, header, separator, names)."""
    head = lines.where((F.col("file_format") == "delimited") & (F.col("line_no") == 0)).groupBy(*FILE).agg(
        F.min(F.ltrim("raw", F.lit(BYTE_ORDER_MARK))).alias("raw")
    )
    count = lambda s: F.length("raw") - F.length(F.replace("raw", F.lit(s)))
    best = F.greatest(*[F.struct(count(s).alias("n"), F.lit(s).alias("s")) for s in SEPARATORS])
    return head.withColumn("separator", best["s"]).select(
        *FILE, F.col("raw").alias("header"), "separator", F.transform(_fields(F.col("raw"), F.col("separator")), lambda x: column_name(F.regexp_replace(x, '"', ""))).alias("names")
    )


def parsed_lines(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """(feed_id, file_no, line_id, file_format, names, fields, reason, raw): two arrays, null for a line that doesn't fit its file.

    A cut-short or stray line - another number of fields than the header, or no JSON object - doesn't; such a line has its
    text and a reason. Fields are as they were delivered; ``cell_value`` cleans them where they are read, outside of lambdas
    and so within generated code. Two fields of one name: both stay.
    """
    heads = broadcast_if_small(heads)
    is_delimited, first = F.coalesce(F.col("file_format") == "delimited", F.lit(False)), F.coalesce(F.col("line_no") == 0, F.lit(False))
    fits, is_map = is_delimited & ~first & (F.size("names") == F.size("_fields")), ~is_delimited & F.col("_map").isNotNull()
    reason = (
        F.when(fits | is_map, None).when(F.col("file_format").isNull(), "no format").when(~is_delimited, "no JSON object")
        .when(F.col("names").isNull(), "no header").when(first, "second header")
        .when(F.size("_fields") < F.size("names"), "fewer fields than the header").otherwise("more fields than the header")
    )
    return (
        clean_lines(lines).join(heads, FILE, "left").where(~(is_delimited & first & F.col("raw").eqNullSafe(F.col("header"))))
        .withColumn("_fields", F.when(is_delimited, _fields(F.col("raw"), F.col("separator"))))
        .withColumn("_map", F.when((F.col("file_format") != "delimited") & F.trim("raw").startswith("{") & F.trim("raw").endswith("}"), F.from_json("raw", "map<string,string>")))
        .select(
            *FILE, "line_id", "file_format",
            F.when(fits, F.col("names")).otherwise(F.transform(F.map_keys("_map"), column_name)).alias("names"),
            F.when(fits, F.col("_fields")).otherwise(F.map_values("_map")).alias("fields"),
            reason.alias("reason"), F.when(reason.isNotNull(), F.col("raw")).alias("raw"),
        )
    )


def unfit_lines(parsed: DataFrame, heads: DataFrame) -> DataFrame:
    """The lines that don't fit their file, with those of their fields that have a certain place.

    These are the fields of a cut-short line before its last one, which may be cut itself. A line with more fields than its
    header, or cut within quotes, has none: any of its fields may be shifted.
    """
    cut = (F.col("reason") == "fewer fields than the header") & (F.regexp_count("raw", F.lit('"')) % 2 == 0)
    at, pair = F.greatest(F.size("_fields") - 1, F.lit(0)), r'"(?:[^"\\]|\\.)*+"\s*:\s*(?:"(?:[^"\\]|\\.)*+"|[^"\s,:{}\[\]]+)'
    whole = F.regexp_extract("raw", rf"(?s)^\s*(\{{.*{pair})\s*,", 1)
    none = F.array().cast("array<string>")
    return (
        parsed.where(F.col("reason").isNotNull()).drop("names", "fields").join(broadcast_if_small(heads.drop("header")), FILE, "left")
        .withColumn("_fields", F.when(cut, _fields(F.col("raw"), F.col("separator"))))
        .withColumn("_map", F.when((F.col("reason") == "no JSON object") & (whole != ""), F.from_json(F.concat(whole, F.lit("}")), "map<string,string>")))
        .select(
            *FILE, "line_id", "file_format",
            F.when(cut, F.slice("names", F.lit(1), at)).otherwise(F.coalesce(F.transform(F.map_keys("_map"), column_name), none)).alias("names"),
            F.when(cut, F.slice("_fields", F.lit(1), at)).otherwise(F.coalesce(F.map_values("_map"), none)).alias("fields"),
            "reason", "raw",
        )
    )


def homeless_lines(lines: DataFrame) -> DataFrame:
    """The lines without feed or file number, as ``unfit_lines`` gives those of files."""
    none = F.array().cast("array<string>")
    return (
        lines.where((F.col("feed_id").isNull() | F.col("file_no").isNull()) & F.col("raw").isNotNull())
        .groupBy(*FILE, "file_format", "line_no", "raw").agg(F.min("line_id").alias("line_id"))
        .select(*FILE, "line_id", "file_format", none.alias("names"), none.alias("fields"), F.lit("no feed or file").alias("reason"), "raw")
    )


def _cells(df: DataFrame, *kept: str) -> DataFrame:
    """A row per cell: the kept columns, name and value (null where missing)."""
    out = df.select(*kept, F.explode(F.arrays_zip("names", "fields")).alias("_c"))
    return out.select(*kept, F.col("_c.names").alias("name"), cell_value(F.col("_c.fields")).alias("value"))


def column_profile(parsed: DataFrame, heads: DataFrame) -> DataFrame:
    """One row per file and column: its number of values by type, its type, and how much it looks like the serial number.

    The columns of a delimited file are those of its header, those of a jsonl file the keys in at least half of its lines.
    """
    cells = _cells(parsed, *FILE).withColumn("kind", F.when(F.col("value").isNotNull(), value_type(F.col("value"))))
    serial_like = F.col("value").rlike(r"^\d{6,}\z") & ~_is_day(F.col("value"))
    dated = F.col("kind").isin("date", "timestamp") & F.col("value").rlike(r"^\d{1,2}[-/.]")
    above_twelve = lambda part: F.regexp_extract("value", r"^(\d+)[-/.](\d+)", part).cast("int") > 12
    by_column = cells.groupBy(*FILE, "name").agg(
        F.count("*").alias("n_lines_with"), F.count("value").alias("n_values"),
        *[F.count_if(F.col("kind") == t).alias(t) for t in TYPES],
        F.count_if(serial_like).alias("n_serial_like"),
        F.count_if(dated).alias("n_small_first"), F.count_if(dated & above_twelve(1)).alias("n_day_first"), F.count_if(dated & above_twelve(2)).alias("n_month_first"),
        F.approx_count_distinct(F.when(serial_like, F.col("value"))).alias("n_distinct"),
    )
    per_file = parsed.groupBy(*FILE).agg(F.count("*").alias("n_lines"), F.max("file_format").alias("file_format"))
    header_columns = heads.select(*FILE, F.explode(F.array_distinct("names")).alias("name"))
    kind = F.lit(None).cast("string")
    for t in TYPES:
        kind = F.when(F.col(t) * 2 > F.col("n_values"), t).otherwise(kind)
    return (
        by_column.join(header_columns.withColumn("in_header", F.lit(True)), [*FILE, "name"], "full")
        .join(per_file, FILE, "left")
        .where(F.col("in_header") | ((F.col("file_format") != "delimited") & (F.col("n_lines_with") * 2 >= F.col("n_lines"))))
        .select(
            *FILE, "name", kind.alias("kind"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_values", *TYPES, "n_small_first", "n_day_first", "n_month_first")],
            (F.coalesce(F.col("n_serial_like"), F.lit(0)) * F.least(F.lit(1.0), F.col("n_distinct") / F.greatest(F.col("n_values"), F.lit(1)))).alias("serial_score"),
        )
    )


def serial_columns(profile: DataFrame) -> DataFrame:
    return profile.groupBy(*FILE).agg(F.max(F.struct("serial_score", "name"))["name"].alias("serial_name"))


def file_pairs(profile: DataFrame) -> DataFrame:
    """Per file with one before it in its feed: its and the earlier file's columns, and the columns that hold the serial number."""
    files = profile.groupBy(*FILE).agg(
        F.array_sort(F.collect_list(F.struct("name", "kind"))).alias("columns"),
        F.max(F.struct("serial_score", "name"))["name"].alias("serial"),
    )
    before = Window.partitionBy("feed_id").orderBy("file_no")
    both = files.select(
        *FILE, F.col("columns").alias("new_columns"), F.col("serial").alias("new_serial"),
        F.lag("file_no").over(before).alias("old_file_no"), F.lag("columns").over(before).alias("old_columns"), F.lag("serial").over(before).alias("old_serial"),
    ).where(F.col("old_file_no").isNotNull())
    names = lambda c: F.transform(c, lambda x: x["name"])
    return both.withColumn("gone", F.array_except(names("old_columns"), names("new_columns"))).withColumn(
        "fresh", F.array_except(names("new_columns"), names("old_columns"))
    )


def _flag(side: str, key: str) -> Column:
    return F.array_contains(f"{side}.keys", key)


def rename_evidence(parsed: DataFrame, pairs: DataFrame) -> DataFrame:
    """How often a gone and a fresh column of two consecutive files agree over the serials for which both have a value.

    Each line goes to the (at most two) comparisons of its file as the old or the new side, keyed by serial number, one value
    per serial and column; no two lines are joined. Returns (feed_id, file_no, old_name, new_name, n_both, n_same)
    and, over the serials for which both hold a flag's word, how many these are, how often both meant the same, how often
    they did so in different words, and how often each said yes.
    """
    asked = pairs.where((F.size("gone") > 0) & (F.size("fresh") > 0))
    roles = asked.select(
        "feed_id", F.explode(F.array(
            F.struct(F.col("file_no").alias("file_no"), F.col("file_no").alias("pair"), F.lit(True).alias("is_new"), F.col("fresh").alias("wanted"), F.col("new_serial").alias("serial")),
            F.struct(F.col("old_file_no").alias("file_no"), F.col("file_no").alias("pair"), F.lit(False).alias("is_new"), F.col("gone").alias("wanted"), F.col("old_serial").alias("serial")),
        )).alias("_role"),
    ).select("feed_id", "_role.*")
    placed = (
        _cells(
            parsed.where(F.col("names").isNotNull()).join(broadcast_if_small(roles), FILE)
            .withColumn("serial_value", F.regexp_replace(cell_value(F.get("fields", (F.array_position("names", F.col("serial")) - 1).cast("int"))), r"\.0+$", ""))
            .where(F.col("serial_value").rlike(r"^\d+\z")),
            "feed_id", "pair", "is_new", "serial_value", "wanted",
        )
        .where(F.array_contains("wanted", F.col("name")) & F.col("value").isNotNull())
        .groupBy("feed_id", "pair", "serial_value", "is_new", "name")
        .agg(F.max("value").alias("value"))
        .withColumn("keys", value_keys(F.col("value")))
    )
    side = lambda new: F.collect_list(F.when(F.col("is_new") == new, F.struct("name", "keys", F.lower("value").alias("word"))))
    met = (
        placed.groupBy("feed_id", "pair", "serial_value").agg(side(False).alias("old"), side(True).alias("new"))
        .where((F.size("old") > 0) & (F.size("new") > 0))
        .select("feed_id", "pair", F.explode("old").alias("old"), "new")
        .select("feed_id", "pair", "old", F.explode("new").alias("new"))
    )
    yes, no = (_flag("old", "b:1"), _flag("new", "b:1")), (_flag("old", "b:0"), _flag("new", "b:0"))
    both_flags, same_flag = (yes[0] | no[0]) & (yes[1] | no[1]), yes[0] & yes[1] | no[0] & no[1]
    return met.groupBy("feed_id", F.col("pair").alias("file_no"), F.col("old.name").alias("old_name"), F.col("new.name").alias("new_name")).agg(
        F.count("*").alias("n_both"), F.count_if(F.arrays_overlap("old.keys", "new.keys")).alias("n_same"),
        F.count_if(both_flags).alias("n_flags"), F.count_if(same_flag).alias("n_flags_same"),
        F.count_if(same_flag & (F.col("old.word") != F.col("new.word"))).alias("n_reworded"),
        F.count_if(both_flags & yes[0]).alias("n_old_yes"), F.count_if(both_flags & yes[1]).alias("n_new_yes"),
    )


def _by_chance(e: dict) -> bool:
    """Whether two columns of flags in different words (live and dead, true and false) agree hardly more than any two flags would (kappa under 0.4).

    Words that are the same on both sides are the same values, whatever their shares; strays aren't flags and don't count.
    """
    if e["n_reworded"] * 2 <= e["n_same"]:
        return False
    yes_old, yes_new, agreed = e["n_old_yes"] / e["n_flags"], e["n_new_yes"] / e["n_flags"], e["n_flags_same"] / e["n_flags"]
    chance = yes_old * yes_new + (1 - yes_old) * (1 - yes_new)
    return chance < 0.95 and (agreed - chance) / (1 - chance) < 0.4


def match_columns(pairs: DataFrame, evidence: DataFrame, min_agreement: float = MIN_AGREEMENT) -> DataFrame:
    """The renamed columns: (feed_id, file_no, old_name, new_name, score, agreement).

    Similarity flooding over the two files' schema graphs (``schema_match``) orders the pairs; each column is used once, from
    the best score downward. The exact check on the values, at least ``min_agreement`` of the serials, decides whether a
    correspondence stands.
    """
    known = evidence.groupBy(*FILE).agg(F.collect_list(F.struct("old_name", "new_name", "n_both", "n_same", "n_flags", "n_flags_same", "n_reworded", "n_old_yes", "n_new_yes")).alias("evidence"))
    ship(pairs.sparkSession)
    graphs = pairs.join(known, FILE).select(*FILE, "old_columns", "new_columns", "evidence")

    def matched(batches):
        for batch in batches:
            found = []
            for feed, file_no, old, new, seen in zip(batch.feed_id, batch.file_no, batch.old_columns, batch.new_columns, batch.evidence, strict=True):
                agreement = {(e["old_name"], e["new_name"]): e["n_same"] / e["n_both"] for e in seen}
                chance = {(e["old_name"], e["new_name"]) for e in seen if _by_chance(e)}
                scores = rename_scores([(c["name"], c["kind"] or "") for c in old], [(c["name"], c["kind"] or "") for c in new], agreement)
                stands = lambda p: agreement.get(p, 0.0) >= min_agreement - 1e-12 and p not in chance  # noqa: B023, E731
                found += [(feed, file_no, a, b, scores[a, b], agreement[a, b]) for a, b in one_to_one(scores, stands)]
            yield pd.DataFrame(found, columns=["feed_id", "file_no", "old_name", "new_name", "score", "agreement"])

    # Few bytes, but work: spread by the number of graphs, which the size of the data wouldn't.
    spread = graphs.repartition(min(int(graphs.sparkSession.conf.get("spark.sql.shuffle.partitions")), pairs.count() // GRAPHS_PER_TASK + 1))
    return spread.mapInPandas(matched, "feed_id string, file_no int, old_name string, new_name string, score double, agreement double")


def schema_changes(pairs: DataFrame, renames: DataFrame) -> DataFrame:
    """(feed_id, file_no, change_kind, old_name, new_name): renamed, removed, added, retyped."""
    by_pair = renames.groupBy(*FILE).agg(F.collect_list(F.struct("old_name", "new_name")).alias("renames"))
    known = pairs.join(by_pair, FILE, "left").withColumn("renames", F.coalesce("renames", F.array().cast("array<struct<old_name:string,new_name:string>>")))
    kinds = lambda c: F.map_from_entries(F.filter(c, lambda x: x["kind"].isNotNull()))
    change = lambda kind, old, new: F.struct(F.lit(kind).alias("change_kind"), old.alias("old_name"), new.alias("new_name"))
    renamed_old, renamed_new = F.col("renames.old_name"), F.col("renames.new_name")
    kept = F.array_except(F.transform("old_columns", lambda x: x["name"]), F.col("gone"))
    carried = F.concat(F.transform(kept, lambda n: F.struct(n.alias("old_name"), n.alias("new_name"))), F.col("renames"))
    changes = F.concat(
        F.transform("renames", lambda r: change("renamed", r["old_name"], r["new_name"])),
        F.transform(F.array_except("gone", renamed_old), lambda n: change("removed", n, F.lit(""))),
        F.transform(F.array_except("fresh", renamed_new), lambda n: change("added", F.lit(""), n)),
        F.transform(
            F.filter(carried, lambda r: F.try_element_at("_old_kinds", r["old_name"]) != F.try_element_at("_new_kinds", r["new_name"])),
            lambda r: change("retyped", r["old_name"], r["new_name"]),
        ),
    )
    return (
        known.withColumn("_old_kinds", kinds("old_columns")).withColumn("_new_kinds", kinds("new_columns"))
        .select(*FILE, F.explode(changes).alias("c")).select(*FILE, "c.*")
    )


class Drift:
    """The steps over one table of lines (columns of ``case_file_lines``), each computed once, when first asked for.

    Defined cases: rows with null feed, file number or text are no part of any file; a feed's first file has no changes; a
    file without any line that fits gives no columns beyond its header; a column without values has no type and is never
    retyped; two lines of one serial in a file count as one, by the greater value; empty input gives empty results; other
    columns are ignored.
    """

    def __init__(self, lines: DataFrame, min_agreement: float = MIN_AGREEMENT) -> None:
        self.lines, self.min_agreement, self.spark = lines, min_agreement, lines.sparkSession

    @cached_property
    def heads(self) -> DataFrame:
        return materialise(headers(self.lines), "headers")

    @cached_property
    def parsed(self) -> DataFrame:
        return materialise(parsed_lines(self.lines, self.heads), "parsed")

    @cached_property
    def profile(self) -> DataFrame:
        return materialise(column_profile(self.parsed, self.heads), "profile")

    @cached_property
    def pairs(self) -> DataFrame:
        return materialise(file_pairs(self.profile), "pairs")

    @cached_property
    def evidence(self) -> DataFrame:
        return rename_evidence(self.parsed, self.pairs)

    @cached_property
    def renames(self) -> DataFrame:
        return materialise(match_columns(self.pairs, self.evidence, self.min_agreement), "renames")

    def steps(self) -> DataFrame:
        """(feed_id, file_no, n_gone, n_fresh, n_kept, n_kept_retyped): how far each file's columns are from those of the file before it, by name alone."""
        kind_of = lambda c: F.map_from_entries(F.filter(c, lambda x: x["kind"].isNotNull()))
        kept = F.array_except(F.transform("old_columns", lambda x: x["name"]), F.col("gone"))
        retyped = F.filter(kept, lambda n: F.try_element_at(kind_of("old_columns"), n) != F.try_element_at(kind_of("new_columns"), n))
        return self.pairs.select(*FILE, F.size("gone").alias("n_gone"), F.size("fresh").alias("n_fresh"), F.size(kept).alias("n_kept"), F.size(retyped).alias("n_kept_retyped"))

    @property
    def serials(self) -> DataFrame:
        """(feed_id, file_no, serial_name): the column that looks most like the serial number."""
        return serial_columns(self.profile)

    def changes(self) -> DataFrame:
        return schema_changes(self.pairs, self.renames)
