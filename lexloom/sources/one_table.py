"""All lines of drifting files in one table: families of columns across files and feeds, typed cells, and nothing left out."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.session import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if_small, materialise
from lexloom.sources import schema_match
from lexloom.sources.schema_drift import (
    DATE, FILE, MONTH, MONTHS, NO, TYPES, YES, Drift, _cells, _is_day, _padded, _time_of_day, cell_value, homeless_lines, unfit_lines,
)

#: Columns of the one table. Beyond them, the cells of rarer families stand in the map ``rarer``, by family.
MAX_COLUMNS = 2_000
#: Buckets for the last words of texts, when kinds of value are compared.
WORD_BUCKETS = 32


def value_token(v: Column) -> Column:
    """The kind of a value, for comparing columns that share no serials: d dates, b flags, n small and m larger numbers, w texts by last word."""
    low = F.lower(v)
    digits = F.regexp_extract(low, r"^[a-z]{0,4}[ _-]?0*(\d+)(\.\d*)?\z", 1)
    return (
        F.when(low.isin(*[w for w in YES if w != "1"]), "b:1").when(low.isin(*[w for w in NO if w != "0"]), "b:0")
        .when(low.rlike(r"^\d{8}\z") & _is_day(low), "d").when(digits != "", F.when((F.length(digits) == 1) | (digits.rlike("^1[0-5]$")), F.concat(F.lit("n:"), digits)).otherwise(F.concat(F.lit("m:"), F.length(digits))))
        .when(low.rlike(rf"^{DATE}"), "d").otherwise(F.concat(F.lit("w:"), F.pmod(F.xxhash64(F.substring_index(low, " ", -1)), F.lit(WORD_BUCKETS))))
    )


def threads(profile: DataFrame, changes: DataFrame) -> DataFrame:
    """Which columns of a feed continue each other: (feed_id, name, start, end, thread).

    A name's stay in a feed begins in the first file that has it and ends before ``end`` (null: lasts); a renamed column
    continues the stay of its old name, and all stays that continue each other are one thread. Chains of renames are followed
    by pointer doubling over the renames alone. Two columns of one file are never in one thread.
    """
    first = profile.groupBy("feed_id").agg(F.min("file_no").alias("file_no"))
    starts = profile.join(first, FILE, "left_semi").select("feed_id", "name", F.col("file_no").alias("start"), F.lit(None).cast("string").alias("old_name")).unionByName(
        changes.where(F.col("change_kind").isin("added", "renamed")).select("feed_id", F.col("new_name").alias("name"), F.col("file_no").alias("start"), F.when(F.col("change_kind") == "renamed", F.col("old_name")).alias("old_name"))
    ).distinct()
    stays = materialise(
        starts.withColumn("end", F.lead("start").over(Window.partitionBy("feed_id", "name").orderBy("start"))).withColumn("id", F.to_json(F.array("feed_id", "name", F.col("start").cast("string")))), "stays"
    )
    before = stays.select("feed_id", F.col("name").alias("old_name"), F.col("start").alias("_from"), F.col("end").alias("_to"), F.col("id").alias("up"))
    links = materialise(
        stays.where(F.col("old_name").isNotNull()).join(before, ["feed_id", "old_name"])
        .where((F.col("_from") < F.col("start")) & (F.col("_to").isNull() | (F.col("_to") > F.col("start")))).select("id", "up"), "links"
    )
    while True:
        above = links.select(F.col("id").alias("up"), F.col("up").alias("_up"))
        further = materialise(links.join(above, "up", "left").select("id", F.coalesce("_up", "up").alias("up"), F.col("_up").isNotNull().alias("_moved")), "links")
        links = further.select("id", "up")
        if further.where("_moved").isEmpty():
            break
    return stays.join(links, "id", "left").select("feed_id", "name", "start", "end", F.coalesce("up", "id").alias("thread"))


def day_of(v: Column, day_first: Column) -> Column:
    """The day of a value as yyyyMMdd, null if it has none; 03/10/1993 by ``day_first``, null where that isn't known and both readings are days."""
    low = F.lower(v)
    part = lambda pattern, k: F.regexp_extract(low, pattern, k)
    rest = r"([t ].*)?\z"
    iso, small_first = rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){rest}", rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}){rest}"
    worded, american = rf"^(\d{{1,2}})[ -]{MONTH}[ ,-]+(\d{{4}}){rest}", rf"^{MONTH} (\d{{1,2}}),? (\d{{4}}){rest}"
    month = lambda name: F.lpad(F.array_position(F.array(*map(F.lit, MONTHS)), name).cast("string"), 2, "0")
    one, two = part(small_first, 1).cast("int"), part(small_first, 2).cast("int")
    as_day, as_month = _padded(part(small_first, 3), part(small_first, 2), part(small_first, 1)), _padded(part(small_first, 3), part(small_first, 1), part(small_first, 2))
    # The usual forms have all their digits in place and need no groups.
    at = lambda start, n: F.substring(low, start, n)
    small = lambda a, b, y: F.when((a > "12") | (a == b), F.concat(y, b, a)).when(b > "12", F.concat(y, a, b)).when(day_first, F.concat(y, b, a)).when(~day_first, F.concat(y, a, b))
    found = (
        F.when(low.rlike(r"^\d{8}\z"), low)
        .when(low.rlike(r"^\d{4}[-/.]\d\d[-/.]\d\d([t ]|\z)"), F.concat(at(1, 4), at(6, 2), at(9, 2)))
        .when(low.rlike(r"^\d\d[-/.]\d\d[-/.]\d{4}([t ]|\z)"), small(at(1, 2), at(4, 2), at(7, 4)))
        .when(low.rlike(r"^\d{4}[-/.]"), _padded(part(iso, 1), part(iso, 2), part(iso, 3)))
        .when(low.rlike(r"^\d{1,2}[-/.]\d"), F.when((one > 12) | (one == two), as_day).when(two > 12, as_month).when(day_first, as_day).when(~day_first, as_month))
        .when(low.rlike(r"^\d"), _padded(part(worded, 3), month(part(worded, 2)), part(worded, 1)))
        .when(low.rlike(r"^[a-z]"), _padded(part(american, 3), month(part(american, 1)), part(american, 2)))
    )
    return F.when(_is_day(found), found)


def number_of(v: Column) -> Column:
    """The number of a value as text, without prefix, suffix and leading zeros: S800 is 800; null if it has none."""
    pattern = r"(?i)^(-(?=[0-9.]+\z))?[a-z]{0,4}[ _-]?0*(\d+?)(?:\.(\d*?)0*)?(?:[ _-]?[a-z]{0,4})\z"
    whole, fraction = F.regexp_extract(v, pattern, 2), F.regexp_extract(v, pattern, 3)
    parsed = F.when(whole != "", F.concat(F.regexp_extract(v, pattern, 1), whole, F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise("")))
    return F.when(v.rlike(r"^(0|[1-9][0-9]*)\z"), v).otherwise(parsed)


def _time_said(v: Column) -> Column:
    """The time of day that a value has behind its date; empty if it has one that isn't kept whole, null if it has none."""
    return F.when((F.length(v) > 10) & v.rlike("[tT ]") & ~F.lower(v).rlike(rf"^{DATE}\z"), F.coalesce(_time_of_day(v), F.lit("")))


def _meaning(kind: str, v: Column, day_first: Column) -> Column:
    """What a value means in a column of the type: its day, number, flag or text; null if it has none."""
    if kind in ("date", "timestamp"):
        return day_of(v, day_first)
    if kind in ("bigint", "double"):
        return number_of(v)
    if kind == "boolean":
        low = F.lower(F.regexp_replace(v, r"^([01])\.0+$", "$1"))
        return F.when(low.isin(*YES), True).when(low.isin(*NO), False)
    return v


def _typed_form(kind: str, m: Column, time: Column) -> Column:
    """The typed value of a meaning and a time of day."""
    if kind == "date":
        return F.try_to_date(m, "yyyyMMdd")
    if kind == "timestamp":  # with a time that isn't kept: the day, and the text in misfits
        day = F.concat(F.substring(m, 1, 4), F.lit("-"), F.substring(m, 5, 2), F.lit("-"), F.substring(m, 7, 2))
        return F.when(m.isNotNull(), F.concat(day, F.lit(" "), F.when(F.coalesce(time, F.lit("")) != "", time).otherwise("00:00:00"))).try_cast("timestamp_ntz")
    return m.try_cast(kind) if kind in ("bigint", "double") else m


def _says_less(kind: str, v: Column, m: Column, time: Column, out: Column) -> Column | None:
    """Whether the typed value ``out`` doesn't keep the value whole; None for texts, which are kept as they are."""
    if kind == "date":
        return out.isNull() | time.isNotNull()
    if kind == "timestamp":
        return out.isNull() | F.coalesce(time == "", F.lit(False))
    if kind in ("bigint", "double"):
        # A double holds fifteen digits.
        plain = r"^[+-]?(0|[1-9][0-9]*|(?=[0-9.]{1,16}\z)(0|[1-9][0-9]*)?\.[0-9]+)\z" if kind == "double" else r"^[+-]?(0|[1-9][0-9]*)(\.0*)?\z"
        same = F.coalesce(out.cast("string") == v, F.lit(False))
        return ~same & (out.isNull() | ~v.rlike(plain) | (F.length(m) > (16 if kind == "double" else 20)))
    return out.isNull() if kind == "boolean" else None


def _by_kind(kind: Column, of: Callable[[str], Column | None], otherwise: Column) -> Column:
    """The text that ``of`` gives for the type that a cell's family has."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k in ("date", "timestamp", "bigint", "double", "boolean"):
        out = out.when(kind == k, of(k).cast("string"))
    return out.otherwise(otherwise)


def _together(numbered: DataFrame, where: list[str]) -> list[list[int]]:
    """The distinct sets of thread numbers that some file, or feed, holds together."""
    sets = numbered.groupBy(*where).agg(F.array_sort(F.collect_set("id")).alias("ids")).where(F.size("ids") > 1)
    return [r["ids"] for r in sets.select("ids").distinct().collect()]


class OneTable:
    """All lines of a ``Drift`` with one set of columns.

    Columns of a feed that continue each other are a thread (``threads``); the threads of all feeds are joined into families by
    similarity flooding (``schema_match.families``), never two columns of one file. A family is called after its most
    frequent name. What a thread has in a file is decided per feed, file and name, so a name may be of one family in one feed
    and of another elsewhere.
    """

    def __init__(self, drift: Drift, max_columns: int = MAX_COLUMNS) -> None:
        self.drift, self.max_columns = drift, max_columns

    @cached_property
    def placed(self) -> DataFrame:
        """The profile of every file's columns with ``thread_names``, the sorted names of the column's thread as one text."""
        profile, stays = self.drift.profile, threads(self.drift.profile, self.drift.changes())
        names = stays.groupBy("thread").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("thread_names"))
        known = stays.join(names, "thread").select("feed_id", "name", "start", "end", "thread_names")
        return materialise(
            profile.join(broadcast_if_small(known), ["feed_id", "name"]).where((F.col("start") <= F.col("file_no")) & (F.col("end").isNull() | (F.col("file_no") < F.col("end")))).drop("start", "end"), "placed"
        )

    @cached_property
    def tokens(self) -> DataFrame:
        """(name, token, n): the kinds of value each name has, over all files."""
        cells = _cells(self.drift.parsed.where(F.col("names").isNotNull()), *FILE).where(F.col("value").isNotNull())
        return cells.groupBy("name", value_token(F.col("value")).alias("token")).agg(F.count("*").alias("n"))

    @cached_property
    def family_of(self) -> dict[str, str]:
        """The family of each thread, by its names."""
        by_thread = self.placed.groupBy("thread_names").agg(F.count("*").alias("n_files"), *[F.sum(t).alias(t) for t in TYPES])
        threads_ = by_thread.orderBy(F.desc("n_files"), "thread_names").collect()
        ids = {r["thread_names"]: i for i, r in enumerate(threads_)}
        if not ids:
            return {}
        known = self._small(list(ids.items()), "thread_names string, id int")
        numbered = materialise(self.placed.join(known, "thread_names").select(*FILE, "name", "id"), "numbered")
        conflicts, neighbours = _together(numbered, FILE), _together(numbered, ["feed_id"])
        wanted = self._small([(n,) for n in sorted({n for names in ids for n in names.split(",")})], "name string")
        values: dict[str, dict[str, int]] = defaultdict(dict)
        for r in self.tokens.join(wanted, "name").collect():
            values[r["name"]][r["token"]] = r["n"]
        columns = [self._node(r, values) for r in threads_]
        group = schema_match.families(columns, [r["n_files"] for r in threads_], conflicts, neighbours)
        per_name: dict[int, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        for r in numbered.groupBy("id", "name").agg(F.count("*").alias("n")).collect():
            per_name[group[r["id"]]][r["name"]] += r["n"]
        called: dict[int, str] = {}
        taken: set[str] = set()
        for g in sorted(per_name, key=lambda g: (-sum(per_name[g].values()), g)):
            names = sorted(per_name[g], key=lambda n: (-per_name[g][n], n))
            called[g] = next((n for n in names if n and n not in taken), f"column_{g}")
            while called[g] in taken or called[g] in ("feed_id", "file_no", "line_id", "misfits", "others", "rarer"):
                called[g] += "_"
            taken.add(called[g])
        return {names: called[group[i]] for names, i in ids.items()}

    def _small(self, rows: list[tuple], schema: str) -> DataFrame:
        """Rows of the driver as a frame, broadcast if their number and size allow it."""
        made = self.drift.spark.createDataFrame(rows, schema)
        size = sum(len(x) if isinstance(x, str) else 8 for row in rows for x in row)
        return F.broadcast(made) if len(rows) <= BROADCAST_ROWS and size <= BROADCAST_BYTES else made

    def _node(self, row, values: dict[str, dict[str, int]]) -> schema_match.ColumnNode:
        names = tuple(row["thread_names"].split(","))
        counts: dict[str, int] = defaultdict(int)
        for n in names:
            for token, k in values.get(n, {}).items():
                counts[token] += k
        total = sum(counts.values()) or 1
        shares = {t: k / total for t, k in counts.items() if k / total >= 0.005}
        if shares.get("n:0", 0) + shares.get("n:1", 0) + shares.get("b:0", 0) + shares.get("b:1", 0) >= 0.85:  # flags as numbers
            for digit in "01":
                shares[f"b:{digit}"] = shares.get(f"b:{digit}", 0.0) + shares.pop(f"n:{digit}", 0.0)
        typed = sum(row[t] for t in TYPES) or 1
        kinds = {"flag": 1.0} if shares.get("b:0", 0) + shares.get("b:1", 0) >= 0.5 else {t: row[t] / typed for t in TYPES if row[t]}
        return schema_match.ColumnNode(names, kinds, shares)

    @cached_property
    def _types(self) -> list[tuple[str, str]]:
        """(family, type) of all families, the most frequent first."""
        sums: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        by_thread = self.placed.groupBy("thread_names", "kind").agg(F.count("*").alias("n_files"), F.sum("n_values").alias("n"), F.sum("timestamp").alias("n_times"))
        known = self._small(list(self.family_of.items()), "thread_names string, family string")
        for r in by_thread.join(known, "thread_names").groupBy("family", "kind").agg(F.sum("n_files").alias("n_files"), F.sum("n").alias("n"), F.sum("n_times").alias("n_times")).collect():
            sums[r["family"]]["files"] += r["n_files"]
            sums[r["family"]]["times"] += r["n_times"]
            if r["kind"]:
                sums[r["family"]][r["kind"]] += r["n"]

        def type_of(name: str) -> str:
            kinds = sums[name]
            if kinds["date"] + kinds["timestamp"]:
                return "timestamp" if kinds["times"] else "date"
            if kinds["boolean"] * 2 > sum(kinds[t] for t in TYPES):
                return "boolean"
            if kinds["decimal"] + kinds["integer"] > kinds["text"]:
                return "double" if kinds["decimal"] > kinds["integer"] else "bigint"
            return "string"

        return [(name, type_of(name)) for name in sorted(sums, key=lambda name: (-sums[name]["files"], name))]

    @cached_property
    def families(self) -> list[tuple[str, str]]:
        """(family, type) of each column of the table, the ``max_columns`` most frequent families, in order of their names."""
        return sorted(self._types[: self.max_columns])

    @cached_property
    def rarer(self) -> list[tuple[str, str]]:
        """(family, type) of the families beyond these, in order of their names."""
        return sorted(self._types[self.max_columns :])

    @cached_property
    def layout(self) -> DataFrame:
        """(feed_id, file_no, columns, rarer): for every file its column of each family, as (name, day_first), null where it has none.

        ``rarer``, where there are such families, has those that the file has of them, as (family, kind, name, day_first).
        """
        known = self._small(list(self.family_of.items()), "thread_names string, family string")
        named = self.placed.join(known, "thread_names").withColumn(
            "day_first", F.when((F.col("n_day_first") > 0) & (F.col("n_month_first") == 0), True).when((F.col("n_month_first") > 0) & (F.col("n_day_first") == 0), False)
        )
        by_family = materialise(named.groupBy(*FILE, "family").agg(F.min_by(F.struct("name", "day_first", "n_small_first", "n_day_first", "n_month_first"), "name").alias("c")).select(*FILE, "family", "c.*"), "columns")
        open_ = by_family.where("day_first is null and n_small_first > 0 and n_day_first = 0 and n_month_first = 0")
        if not open_.isEmpty():
            by_family = by_family.join(self._by_serial(by_family, open_), [*FILE, "family"], "left").withColumn("day_first", F.coalesce("day_first", "_by_serial"))
        entry, rarer = F.struct("family", F.struct("name", "day_first")), []
        if self.rarer:
            by_family = by_family.join(self._small(self.rarer, "family string, kind string"), "family", "left")
            entry, rarer = F.when(F.col("kind").isNull(), entry), [F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("family", "kind", "name", "day_first")))).alias("rarer")]
        by_file = by_family.groupBy(*FILE).agg(F.map_from_entries(F.collect_list(entry)).alias("_at"), *rarer)
        return materialise(by_file.select(*FILE, *(["rarer"] if rarer else []), F.array(*[F.try_element_at("_at", F.lit(n)) for n, _ in self.families]).cast("array<struct<name:string,day_first:boolean>>").alias("columns")), "layout")

    def _by_serial(self, columns: DataFrame, undecided: DataFrame) -> DataFrame:
        """For columns whose dates could all be read either way: the reading with which more serials agree with the feed's other files."""
        asked = undecided.select("feed_id", "family").distinct()
        wanted = columns.join(broadcast_if_small(asked), ["feed_id", "family"], "left_semi").groupBy(*FILE).agg(F.collect_list(F.struct("family", "name", "day_first", "n_small_first")).alias("wanted"))
        lines = self.drift.parsed.where(F.col("names").isNotNull()).join(broadcast_if_small(wanted), FILE).join(broadcast_if_small(self.drift.serials), FILE)
        cell = lambda name: cell_value(F.get("fields", (F.array_position("names", name) - 1).cast("int")))
        cells = lines.withColumn("serial", F.regexp_replace(cell(F.col("serial_name")), r"\.0+$", "")).where(F.col("serial").rlike(r"^\d+\z")).select(*FILE, "serial", "names", "fields", F.explode("wanted").alias("w"))
        cells = cells.select(*FILE, "serial", "w.family", "w.day_first", "w.n_small_first", cell(F.col("w.name")).alias("value")).where(F.col("value").isNotNull())
        is_open = F.col("day_first").isNull() & (F.col("n_small_first") > 0)
        both = cells.withColumn("as_day", day_of(F.col("value"), F.lit(True))).withColumn("as_month", day_of(F.col("value"), F.lit(False)))
        asking = both.where(is_open & (F.col("as_day") != F.col("as_month"))).select(*FILE, "serial", "family", "as_day", "as_month")
        known = cells.where(~is_open).select("feed_id", "serial", "family", day_of(F.col("value"), F.col("day_first")).alias("day")).where(F.col("day").isNotNull()).distinct()
        met = asking.join(known, ["feed_id", "serial", "family"]).groupBy(*FILE, "family").agg(F.count_if(F.col("day") == F.col("as_day")).alias("_d"), F.count_if(F.col("day") == F.col("as_month")).alias("_m"))
        return met.where("_d <> _m").select(*FILE, "family", (F.col("_d") > F.col("_m")).alias("_by_serial"))

    def lines(self) -> DataFrame:
        """Every line once: feed_id, file_no, line_id, a column per family, misfits, others, _reason, _raw.

        Dates become dates, or timestamps without zone in families with times of day; numbers doubles or longs without
        prefix. ``misfits`` (family to text) has every value that its typed form doesn't keep whole: null there, without its
        time of day, prefix, leading zeros or last digits. ``others`` has the cells, as (name, value), that no column takes: a
        second field of one name, keys of few of a file's lines. With more families than ``max_columns`` there is also
        ``rarer`` (family to text), which has the typed values of those beyond as text. A line that doesn't fit its file has
        ``_reason`` and ``_raw``, and those of its fields that have a certain place. So every cell is found again.
        """
        rest = unfit_lines(self.drift.parsed, self.drift.heads).unionByName(homeless_lines(self.drift.lines))
        everything = self.drift.parsed.where(F.col("names").isNotNull()).unionByName(rest).join(broadcast_if_small(self.layout), FILE, "left")
        return self._typed(everything)

    def fitting(self) -> DataFrame:
        """The lines that fit their file."""
        return self.lines().where(F.col("_reason").isNull()).drop("_reason", "_raw")

    def _typed(self, lines: DataFrame) -> DataFrame:
        place = lambda name: F.array_position("names", name)
        own = F.transform("_places", lambda p: cell_value(F.get("fields", p - 1)))
        n_own = F.aggregate("_places", F.lit(0), lambda n, p: n + F.when(p > 0, 1).otherwise(0))
        column_names = F.coalesce(F.transform("columns", lambda c: c["name"]), F.array().cast("array<string>"))
        rarer = []
        if self.rarer:
            lines = lines.withColumn("rarer", F.coalesce("rarer", F.array().cast(lines.schema["rarer"].dataType)))
            column_names = F.concat(column_names, F.transform("rarer", lambda c: c["name"]))
            n_own += F.size(F.filter("rarer", lambda c: place(c["name"]) > 0))
            cell = lambda c: F.struct(c["family"], c["kind"], c["day_first"], cell_value(F.get("fields", (place(c["name"]) - 1).cast("int"))).alias("value"))
            rarer = [F.filter(F.transform("rarer", cell), lambda c: c["value"].isNotNull()).alias("_rarer")]
        elsewhere = lambda x, i: F.when(~F.coalesce(F.array_contains("_names", x["names"]) & (place(x["names"]) == i + 1), F.lit(False)), F.struct(x["names"].alias("name"), cell_value(x["fields"]).alias("value")))
        placed = lines.select("*", column_names.alias("_names"), F.transform("columns", lambda c: place(c["name"]).cast("int")).alias("_places"))
        rest = F.filter(F.transform(F.arrays_zip("names", "fields"), elsewhere), lambda x: x["value"].isNotNull())
        rows = placed.select(
            *FILE, "line_id", own.alias("_cells"), F.transform("columns", lambda c: c["day_first"]).alias("_day_first"), n_own.alias("_n_own"), "names", "fields", "_names",
            F.col("reason").alias("_reason"), F.col("raw").alias("_raw"), *rarer,
        )
        # What a cell means is worked out once, in plain columns: the optimizer would copy the parts of a struct into every use.
        meanings, typed, cut = [], [], []
        for i, (name, kind) in enumerate(self.families):
            value, at = F.get("_cells", F.lit(i)), f"_m{i}"
            meanings.append(_meaning(kind, value, F.get("_day_first", F.lit(i))).alias(at))
            if kind in ("date", "timestamp"):
                meanings.append(_time_said(value).alias(f"_t{i}"))
            m, time, out = F.col(at), F.col(f"_t{i}"), F.col(f"`{name}`")
            typed.append(_typed_form(kind, m, time).alias(name))
            said_less = _says_less(kind, value, m, time, out)
            if said_less is not None:
                cut.append((name, i, said_less))
        # In one step with the lambdas of ``others``, so these many expressions are compiled apart and not as one method, which would be too large.
        others = F.when(F.size("names") == F.col("_n_own"), F.array().cast("array<struct<name:string,value:string>>")).otherwise(rest)
        known = rows.select(*FILE, "line_id", "_cells", others.alias("others"), "_reason", "_raw", *meanings, *([self._rarer_cells().alias("_rarer")] if rarer else []))
        out = known.select(*FILE, "line_id", *typed, "_cells", "others", "_reason", "_raw", *[c for c in known.columns if c[:2] in ("_m", "_t", "_r") and c not in ("_reason", "_raw")])
        lost = [F.when(F.get("_cells", F.lit(i)).isNotNull() & said_less, F.struct(F.lit(name).alias("key"), F.get("_cells", F.lit(i)).alias("value"))) for name, i, said_less in cut]
        entries = F.filter(F.array(*lost), lambda x: x.isNotNull()) if lost else F.array().cast("array<struct<key:string,value:string>>")
        more = []
        if rarer:
            entries = F.concat(entries, F.transform(F.filter("_rarer", lambda c: c["less"]), lambda c: F.struct(c["family"].alias("key"), c["value"].alias("value"))))
            more = [F.map_from_entries(F.transform(F.filter("_rarer", lambda c: c["out"].isNotNull()), lambda c: F.struct(c["family"], c["out"]))).alias("rarer")]
        return out.select(*FILE, "line_id", *[F.col(f"`{n}`") for n, _ in self.families], *more, F.map_from_entries(entries).alias("misfits"), "others", "_reason", "_raw")

    def _rarer_cells(self) -> Column:
        """The cells of rarer families as (family, value, out, less): the typed value as text, and whether it doesn't keep the value whole.

        Their families aren't known when the plan is made, only their types are, so what follows is as long as there are types.
        """
        form = lambda c, of, otherwise: _by_kind(c["kind"], of, otherwise)
        meant = F.transform("_rarer", lambda c: F.struct(
            c["family"], c["kind"], c["value"], form(c, lambda k: _meaning(k, c["value"], c["day_first"]), c["value"]).alias("m"), F.when(c["kind"].isin("date", "timestamp"), _time_said(c["value"])).alias("time"),
        ))
        typed = F.transform(meant, lambda c: F.struct(c["family"], c["kind"], c["value"], c["m"], c["time"], form(c, lambda k: _typed_form(k, c["m"], c["time"]), c["value"]).alias("out")))
        less = lambda c: form(c, lambda k: _says_less(k, c["value"], c["m"], c["time"], c["out"]), F.lit("false")).cast("boolean")
        return F.transform(typed, lambda c: F.struct(c["family"], c["value"], c["out"], F.coalesce(less(c), F.lit(False)).alias("less")))

    def cell_counts(self) -> DataFrame:
        """(feed_id, file_no, n_lines, n_cells): of the lines that fit, the lines and the non-missing cells that the table holds in columns, rarer, misfits or others."""
        held = F.size("others")
        if self.rarer:
            held += F.size(F.array_union(F.map_keys("rarer"), F.array_except(F.map_keys("misfits"), F.array(*[F.lit(n) for n, _ in self.families]).cast("array<string>"))))
        for name, _ in self.families:
            held += F.when(F.col(f"`{name}`").isNotNull() | F.coalesce(F.map_contains_key("misfits", F.lit(name)), F.lit(False)), 1).otherwise(0)
        return self.lines().where(F.col("_reason").isNull()).groupBy(*FILE).agg(F.count("*").alias("n_lines"), F.sum(held).cast("bigint").alias("n_cells"))
