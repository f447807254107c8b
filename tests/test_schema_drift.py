"""Drifting schemas: files written here with known changes, and the defined cases."""

import json
import random

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from lexloom.plans import problems
from lexloom.sources import one_table, schema_match
from lexloom.sources import schema_drift as sd

LINES = "line_id bigint, feed_id string, file_no int, file_name string, file_format string, line_no int, raw string, names string"


def lines_of(spark, files):
    """files: (feed, number, format, separator, [lines])."""
    out = []
    for feed, number, form, lines in files:
        for i, line in enumerate(lines):
            out.append((len(out), feed, number, "f", form, i if form == "delimited" else i + 1, line, "x"))
    return spark.createDataFrame(out, LINES)


def csv(separator, header, records):
    return [separator.join(header)] + [separator.join(str(r[h]) if r[h] is not None else "N/A" for h in header) for r in records]


def people(n, seed=1):
    draw = random.Random(seed)
    return [{"serial": 90000000 + i, "mark": f"Name {draw.randrange(10**6)}x", "code": draw.randrange(1, 6), "filed": f"{draw.randrange(1950, 2020)}{draw.randrange(1, 13):02d}{draw.randrange(1, 29):02d}", "fee": f"{draw.randrange(100, 900)}.50"} for i in range(n)]


@pytest.fixture(scope="module")
def drift(spark):
    base = people(60)
    iso = lambda d: f"{d[:4]}-{d[4:6]}-{d[6:]}"
    one = csv(",", ["serial", "mark", "code", "filed", "fee"], base)
    renamed = [{"SER.NO": r["serial"], "wordmark": r["mark"].upper(), "code": f"DC{r['code']}", "filed on": iso(r["filed"]), "flag": "true"} for r in base[20:]]
    two = csv("|", ["wordmark", "code", "filed on", "SER.NO", "flag"], renamed)
    two += ["stray line", two[5][:10]]  # stray, cut short
    three = [json.dumps({"ser_no": r["SER.NO"], "wordmark": r["wordmark"], "code": r["code"], "filed_on": r["filed on"] + "T10:15:00Z", "flag": None if i % 2 else True}) for i, r in enumerate(renamed)] + ['{"ser_no": 1, "rare": 2}', '{"ser_no": 90', "7,8"]
    lines = lines_of(spark, [("a", 1, "delimited", one), ("a", 2, "delimited", two), ("a", 5, "jsonl", three), ("b", 1, "delimited", one)])
    return sd.Drift(lines.unionByName(lines.where("line_no in (0, 3)").withColumn("line_id", F.col("line_id") + 1000)))  # delivered twice


def test_changes(drift):
    assert rows(drift.changes()) == sorted([
        ("a", 2, "renamed", "serial", "ser_no"), ("a", 2, "renamed", "mark", "wordmark"), ("a", 2, "renamed", "filed", "filed_on"), ("a", 2, "retyped", "filed", "filed_on"),
        ("a", 2, "retyped", "code", "code"), ("a", 2, "removed", "fee", ""), ("a", 2, "added", "", "flag"), ("a", 5, "retyped", "filed_on", "filed_on"),
    ], key=repr)


def test_one_table(drift):
    one = one_table.OneTable(drift)
    table = one.fitting()
    assert table.count() == 60 + 40 + 41 + 60  # lines that don't fit their file are out, those that came twice count once
    serial = one.family_of["serial"]
    assert one.family_of["ser_no,serial"] == serial
    assert {serial, "fee", "flag"} <= set(table.columns) and dict(table.dtypes)["flag"] == "boolean"
    dates = [c for c, t in table.dtypes if t == "timestamp_ntz"]
    assert len(dates) == 1 and len(table.columns) == 3 + 6 + 2
    per_serial = table.where("feed_id = 'a'").groupBy(serial).agg(F.count_distinct(F.to_date(dates[0])).alias("n")).where("n > 1")
    assert per_serial.count() == 0


def test_every_line_is_in_the_one_table(spark):
    base = people(8)
    one = csv(",", ["serial", "mark", "fee"], base) + ["90000020,Cut", "90000021,Long,1.50,7", "stray", '90000022,"Cut']
    two = [json.dumps({"serial": r["serial"], "mark": r["mark"], "fee": r["fee"]}) for r in base] + ['{"serial": 90000023, "mark": "A, b", "fee": "1', "7,8"]
    lines = lines_of(spark, [("a", 1, "delimited", one), ("a", 2, "jsonl", two), ("a", 3, "delimited", one[:1] + ["serial,mark,cost"]), (None, 4, "jsonl", ["{}"])])
    drift = sd.Drift(lines.unionByName(lines.withColumn("line_id", F.col("line_id") + 1000)).withColumn("line_no", F.when((F.col("feed_id") == "a") & (F.col("file_no") == 3), 0).otherwise(F.col("line_no"))))
    table = one_table.OneTable(drift).lines()
    assert table.count() == lines.count() - 2 and one_table.OneTable(drift).fitting().count() == 16  # all but the two headers in use
    assert rows(table.where("_reason is not null").select("_reason", "_raw", "serial", "mark", "fee")) == sorted([
        ("fewer fields than the header", "90000020,Cut", 90000020, None, None), ("more fields than the header", "90000021,Long,1.50,7", None, None, None),
        ("fewer fields than the header", "stray", None, None, None), ("fewer fields than the header", '90000022,"Cut', None, None, None),
        ("no JSON object", two[-2], 90000023, "A, b", None), ("no JSON object", "7,8", None, None, None), ("second header", "serial,mark,fee", None, None, None), ("no feed or file", "{}", None, None, None),
    ], key=repr)


def test_typed_cells_lose_nothing_unseen(spark):
    base = [{"serial": 90000000 + i, "at": f"2009-11-{i + 1:02d}", "code": str(i + 1), "rate": f"{i}.5"} for i in range(20)]
    base[1:5] = [
        {"serial": 90000001, "at": "2009-11-27 22:15:00", "code": "S800", "rate": "-2.5"}, {"serial": 90000002, "at": "11/27/2009 9:05", "code": "-5", "rate": "7"},
        {"serial": 90000003, "at": "2009-11-27 10:15 pm", "code": "007", "rate": "12345678901234567.25"}, {"serial": 90000004, "at": "2009-11-27T22:15:00+02:00", "code": "7.0", "rate": "none"},
    ]
    base[5] |= {"at": "2009-11-28 see file"}
    drift = sd.Drift(lines_of(spark, [("a", 1, "delimited", csv("|", ["serial", "at", "code", "rate"], base))]))
    table = one_table.OneTable(drift).lines()
    assert {c: t for c, t in table.dtypes if c in ("at", "code", "rate")} == {"at": "timestamp_ntz", "code": "bigint", "rate": "double"}
    found = {r.serial - 90000000: (str(r.at), r.code, r.rate, r.misfits) for r in table.collect()}
    assert found[0] == ("2009-11-01 00:00:00", 1, 0.5, {}) and found[1] == ("2009-11-27 22:15:00", 800, -2.5, {"code": "S800"}) and found[2] == ("2009-11-27 09:05:00", -5, 7.0, {})
    assert found[3] == ("2009-11-27 00:00:00", 7, 12345678901234567.25, {"at": "2009-11-27 10:15 pm", "code": "007", "rate": "12345678901234567.25"})
    assert found[4] == ("2009-11-27 00:00:00", 7, None, {"at": "2009-11-27T22:15:00+02:00", "rate": "none"})
    assert found[5] == ("2009-11-28 00:00:00", 6, 5.5, {"at": "2009-11-28 see file"})


def test_matched_columns_come_from_the_graph(drift):
    found = drift.renames.where("file_no = 2").collect()
    assert len(found) == 3 and all(0 < r["score"] <= 1 and r["agreement"] >= 2 / 3 for r in found)


def test_flooding_prefers_the_column_whose_values_agree():
    scores = schema_match.rename_scores([("filing_dt", "integer"), ("reg_dt", "integer")], [("filed_on", "date"), ("reg_dt", "integer")], {("filing_dt", "filed_on"): 0.95, ("filing_dt", "reg_dt"): 0.0})
    assert scores["filing_dt", "filed_on"] > scores.get(("filing_dt", "reg_dt"), 0) and scores["reg_dt", "reg_dt"] > scores.get(("reg_dt", "filed_on"), 0)


def _twice_filed(spark):
    """A column is gone and two fresh ones hold its values: the one whose name has nothing to do with it in a few lines more."""
    base = people(40)
    late = [{"serial": r["serial"], "zone": r["filed"], "filed_on": r["filed"] if i > 3 else "19000101"} for i, r in enumerate(base)]
    return lines_of(spark, [("x", 1, "delimited", csv(",", ["serial", "filed"], base)), ("x", 2, "delimited", csv(",", ["serial", "zone", "filed_on"], late))])


def test_flooding_selects_the_renamed_column(spark):
    lines = _twice_filed(spark)
    assert ("x", 2, "renamed", "filed", "filed_on") in rows(sd.Drift(lines).changes())
    ev = {("filed", "zone"): 1.0, ("filed", "filed_on"): 0.9}
    by_values = schema_match.one_to_one(ev, lambda p: ev[p] >= 2 / 3)
    by_flooding = schema_match.one_to_one(schema_match.rename_scores([("serial", "integer"), ("filed", "integer")], [("serial", "integer"), ("zone", "integer"), ("filed_on", "integer")], ev), lambda p: ev.get(p, 0) >= 2 / 3)
    assert by_values == [("filed", "zone")] and by_flooding == [("filed", "filed_on")]


def _feeds(spark):
    """Three feeds that never rename, but call the same things by other names; every file has dates of its own."""
    base, out = people(60), []
    firms = ["Holdings", "Mills", "Estates", "Foundry"]
    for feed, (reg, pub, owner, fee) in {"a": ("reg_dt", "pub_dt", "owner_nm", "fee_amt"), "b": ("registered_on", "published", "holder", "filing_fee"), "c": ("registration_dt", "publication_dt", "owner_name", "fee_paid")}.items():
        made = [{"serial": int(r["serial"]) + 1000 * ord(feed), reg: r["filed"], pub: str(int(r["filed"]) - 1), owner: f"{r['mark']} {firms[i % 4]}", fee: r["fee"]} for i, r in enumerate(base)]
        out.append((feed, 1, "delimited", csv(",", ["serial", reg, pub, owner, fee], made)))
    return lines_of(spark, out)


def test_columns_of_other_feeds_are_joined_by_flooding(spark, monkeypatch):
    lines = _feeds(spark)
    one = one_table.OneTable(sd.Drift(lines))
    assert len(one.families) == 5 and one.family_of["holder"] == one.family_of["owner_nm"] == one.family_of["owner_name"]
    assert one.family_of["reg_dt"] == one.family_of["registered_on"] == one.family_of["registration_dt"] != one.family_of["pub_dt"] == one.family_of["published"]
    monkeypatch.setattr(schema_match, "flood", lambda seeds, edges: {})
    assert len(one_table.OneTable(sd.Drift(lines)).families) == 13  # without it, the three feeds have nothing in common but the serial


def test_two_columns_of_one_file_are_never_one(spark):
    base = people(30)
    f1 = [("f1", 1, "delimited", csv(",", ["serial", "alpha"], [{"serial": r["serial"], "alpha": r["mark"]} for r in base])), ("f1", 2, "delimited", csv(",", ["serial", "beta"], [{"serial": r["serial"], "beta": r["mark"]} for r in base]))]
    f2 = [("f2", n, "delimited", csv(",", ["serial", "alpha", "beta"], [{"serial": r["serial"], "alpha": f"a{i}", "beta": f"b{i}"} for i, r in enumerate(base)])) for n in (1, 2)]
    one = one_table.OneTable(sd.Drift(lines_of(spark, f1 + f2)))
    table = one.lines()
    assert table.where("feed_id = 'f2' and alpha is not null and beta is not null").count() == 60
    in_f1 = one.family_of["alpha,beta"]
    assert table.where(f"feed_id = 'f1' and {in_f1} is not null").count() == 60 and table.where("size(others) > 0").count() == 0


def test_names_that_come_again_in_one_feed(spark):
    """a is renamed to b, then a new a comes beside b: two threads, and nothing is lost."""
    base = people(30)
    of = lambda **c: csv(",", ["serial", *c], [{"serial": r["serial"], **{n: v(r) for n, v in c.items()}} for r in base])
    mark, fee = (lambda r: r["mark"]), (lambda r: r["fee"])
    one = one_table.OneTable(sd.Drift(lines_of(spark, [("f", 1, "delimited", of(a=mark)), ("f", 2, "delimited", of(b=mark)), ("f", 3, "delimited", of(a=fee, b=mark)), ("f", 4, "delimited", of(a=fee, c=mark))])))
    assert set(one.family_of) == {"serial", "a,b,c", "a"} and len(one.families) == 3
    marks = one.family_of["a,b,c"]
    assert one.lines().where(F.col(marks).startswith("Name")).count() == 120


def test_days_first_is_decided_by_column_and_by_serial(spark):
    days = [f"{1960 + i}{i % 12 + 1:02d}{i % 20 + 1:02d}" for i in range(40)]
    few = [i for i, d in enumerate(days) if d[6:] <= "12" and d[4:6] != d[6:]][:8]  # all of them could be read either way
    eu, us = (lambda d: f"{d[6:]}/{d[4:6]}/{d[:4]}"), (lambda d: f"{d[4:6]}/{d[6:]}/{d[:4]}")
    side = lambda form, at: csv(",", ["serial", "filed"], [{"serial": 90000000 + i, "filed": form(days[i])} for i in at])
    everyone = range(40)
    one = one_table.OneTable(sd.Drift(lines_of(spark, [
        ("eu", 1, "delimited", side(eu, everyone)), ("us", 1, "delimited", side(us, everyone)),
        ("open", 1, "delimited", side(eu, few)), ("met", 1, "delimited", side(eu, few)), ("met", 2, "delimited", side(lambda d: d, everyone)),
    ])))
    table = one.lines()
    wrong = [r for r in table.where("feed_id <> 'open'").collect() if r.filed.strftime("%Y%m%d") != days[r.serial - 90000000]]
    assert wrong == [] and table.where("size(misfits) > 0 and feed_id <> 'open'").count() == 0
    assert table.where("feed_id = 'open' and filed is null and misfits['filed'] is not null").count() == len(few)


def test_cells_without_a_column_stay_in_others(spark):
    lines = lines_of(spark, [("a", 1, "delimited", ["serial,b,B", "90000001,x,y"]), ("a", 2, "jsonl", ['{"serial": 90000001, "b": "x"}', '{"serial": 90000002, "b": "z"}', '{"serial": 90000003, "b": "z", "rare": 5, "B": "w"}'])])
    one = one_table.OneTable(sd.Drift(lines))
    found = {r.line_id: sorted(tuple(o) for o in r.others) for r in one.lines().collect()}
    assert sorted(x for v in found.values() for x in v) == [("b", "w"), ("b", "y"), ("rare", "5")]
    narrow = one_table.OneTable(sd.Drift(lines), max_columns=1)
    assert len(narrow.families) == 1 and rows(narrow.cell_counts()) == rows(one.cell_counts()) == [("a", 1, 1, 3), ("a", 2, 3, 8)]


def _whole(table):
    """line -> (typed values by family as text, misfits, others), wherever the values stand."""
    columns = [c for c in table.columns if c not in ("feed_id", "file_no", "line_id", "rarer", "misfits", "others", "_reason", "_raw")]
    found = table.select("line_id", F.struct(F.lit("").alias("_"), *[F.col(c).cast("string").alias(c) for c in columns]).alias("c"), *[c for c in table.columns if c in ("rarer", "misfits", "others")]).collect()
    return {r.line_id: ({k: v for k, v in r.c.asDict().items() if k != "_" and v is not None} | (r.rarer if "rarer" in table.columns else {}), r.misfits, sorted(map(tuple, r.others))) for r in found}


def test_families_beyond_the_columns_are_found_and_typed_all_the_same(spark):
    odd = [{"serial": 90000000 + i, "at": f"2009-11-{i + 1:02d}", "day": f"{i + 1}/11/2009", "code": str(i + 1), "rate": f"{i}.5", "live": "true", "text": f"x{i} y"} for i in range(20)]
    odd[1:5] = [
        {"serial": 90000001, "at": "2009-11-27 22:15:00", "day": "5/6/2009", "code": "S800", "rate": "-2.5", "live": "?", "text": None}, {"serial": 90000002, "at": "11/27/2009 9:05", "day": "see file", "code": "-5", "rate": "7", "live": "N", "text": "-"},
        {"serial": 90000003, "at": "2009-11-27 10:15 pm", "day": None, "code": "007", "rate": "12345678901234567.25", "live": None, "text": "7"}, {"serial": 90000004, "at": "2009-11-27T22:15:00+02:00", "day": "31/11/2009", "code": "7.0", "rate": "none", "live": "0.0", "text": "NULL"},
    ]
    more = lines_of(spark, [("d", 1, "delimited", csv("|", list(odd[0]) + ["text"], odd) + ["90000001|2009-11-27 10:15 pm|5/6"]), ("d", 2, "jsonl", [json.dumps(r) for r in odd] + ['{"serial": 1, "rare": 2}'])])
    drift = sd.Drift(_feeds(spark).unionByName(more.withColumn("line_id", F.col("line_id") + 1000)).unionByName(lines_of(spark, [(None, 1, "jsonl", ["{}"])]).withColumn("line_id", F.lit(5000))))
    wide = one_table.OneTable(drift)
    assert "rarer" not in wide.lines().columns and {t for _, t in wide.families} == {"timestamp", "date", "bigint", "double", "boolean", "string"}
    whole, counts = _whole(wide.lines()), rows(wide.cell_counts())
    for n in (0, 4):
        narrow = one_table.OneTable(drift, max_columns=n)
        assert len(narrow.families) == n and sorted(narrow.families + narrow.rarer) == wide.families and narrow.family_of == wide.family_of
        assert _whole(narrow.lines()) == whole and rows(narrow.cell_counts()) == counts


def test_more_threads_than_columns_are_matched(spark, tmp_path):
    """The rarest spelling goes to the family of the most frequent ones, whatever fits into the columns."""
    _feeds(spark).write.parquet(f"{tmp_path}/case_file_lines.parquet")
    all_of_them = rows(problems.p4_families(spark, str(tmp_path)))
    assert len(all_of_them) == 15 and len({r[3] for r in all_of_them}) == 5
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(one_table.OneTable.__init__, "__defaults__", (2,))
        assert rows(problems.p4_families(spark, str(tmp_path))) == all_of_them


def test_a_column_below_two_thirds_is_not_the_same(spark):
    base = people(30)
    other = [{"serial": r["serial"], "cost": r["fee"] if i < 19 else "1.00"} for i, r in enumerate(base)]  # 19 of 30
    same = [{"serial": r["serial"], "cost": r["fee"] if i < 20 else "1.00"} for i, r in enumerate(base)]  # 20 of 30
    one = csv(",", ["serial", "fee"], base)
    found = sd.Drift(lines_of(spark, [("x", 1, "delimited", one), ("x", 2, "delimited", csv(",", ["serial", "cost"], other)), ("y", 1, "delimited", one), ("y", 2, "delimited", csv(",", ["serial", "cost"], same))]))
    assert rows(found.changes()) == [("x", 2, "added", "", "cost"), ("x", 2, "removed", "fee", ""), ("y", 2, "renamed", "fee", "cost")]


def _flag_files(feed, old, new):
    """Two files of one feed whose only other column is a flag under two names."""
    base = people(len(old))
    side = lambda name, words: csv(",", ["serial", name], [{"serial": r["serial"], name: w} for r, w in zip(base, words, strict=True)])
    return [(feed, 1, "delimited", side("status", old)), (feed, 2, "delimited", side("state_cd", new))]


def test_flags_in_the_same_words_are_not_struck_out_as_chance(spark):
    skewed = ["LIVE"] * 36 + ["DEAD"] + ["LIVE"] * 2 + ["TBD"], ["LIVE"] * 36 + ["DEAD"] + ["?"] * 2 + ["LIVE"]
    reworded = ["LIVE"] * 36 + ["DEAD"] + ["LIVE"] * 2 + ["TBD"], ["true"] * 36 + ["false"] + ["?"] * 2 + ["true"]
    unrelated = ["LIVE"] * 36 + ["DEAD"] * 4, ["true"] * 32 + ["false"] * 4 + ["true"] * 4
    found = sd.Drift(lines_of(spark, _flag_files("a", *skewed) + _flag_files("b", *reworded) + _flag_files("c", *unrelated)))
    assert [r for r in rows(found.changes()) if r[2] != "retyped"] == [
        ("a", 2, "renamed", "status", "state_cd"), ("b", 2, "renamed", "status", "state_cd"), ("c", 2, "added", "", "state_cd"), ("c", 2, "removed", "status", ""),
    ]


def test_defined_cases(spark):
    empty = lines_of(spark, [("a", 1, "delimited", ["a,b"])]).limit(0)
    assert rows(sd.Drift(empty).changes()) == [] and one_table.OneTable(sd.Drift(empty)).lines().count() == 0
    odd = lines_of(spark, [("a", 1, "delimited", ["serial,b,B"]), ("a", 2, "delimited", ["serial,c", "x" * 100_000, '"90000001",""'])])
    nulls = spark.createDataFrame([(1, None, 1, "f", "jsonl", 1, "{}", ""), (2, "z", None, "f", "jsonl", 1, "{}", ""), (3, "z", 1, "f", "jsonl", 1, None, "")], LINES)
    assert rows(sd.Drift(odd.unionByName(nulls)).changes()) == [("a", 2, "added", "", "c"), ("a", 2, "removed", "b", "")]


@pytest.mark.parametrize(("value", "kind"), [
    ("19990406", "integer"), ("007", "integer"), ("5.0", "decimal"), ("TRUE", "boolean"), ("1999-04-06", "date"), ("04/06/1999", "date"), ("6 Apr 1999", "date"),
    ("1999-04-06 10:15:00", "timestamp"), ("1999-04-06T10:15:00Z", "timestamp"), ("DC4", "text"), ("4-std", "text"), ("see file", "text"), ("-5", "text"),
])
def test_types(spark, value, kind):
    assert spark.range(1).select(sd.value_type(F.lit(value))).first()[0] == kind


@pytest.mark.parametrize(("a", "b", "same"), [
    ("19990406", "04/06/1999", True), ("19990406", "6 Apr 1999", True), ("1999-04-06T10:15:00Z", "19990406", True), ("5", "DC5", True), ("5.0", "0005", True), ("S733", "733.0", True),
    ("IC-26", "026", True), ("LIVE", "L", True), ("1", "true", True), ("Élan vital", "ELAN-VITAL", True), ("Žižkaş", "zizkas", True), ("Привет", "привет", True), ("Привет", "пока", False), ("4", "5", False), ("19990406", "19990407", False), ("511.00", "511", True), ("10", "1", False), ("100", "1", False),
])
def test_values_in_other_forms(spark, a, b, same):
    assert spark.range(1).select(F.arrays_overlap(sd.value_keys(F.lit(a)), sd.value_keys(F.lit(b)))).first()[0] == same


def test_separators_in_quotes(spark):
    df = spark.createDataFrame([('"a,b",2,"say ""x""",',)], "line string").select(sd._separated(F.col("line"), ",").alias("f"))
    assert [x for x in df.first()[0]] == ['"a,b"', "2", '"say ""x"""', ""]


def test_columns_of_one_feed_need_more_than_like_values():
    node, flags = schema_match.ColumnNode, {"b:1": 0.6, "b:0": 0.4}
    live, std, claim = node(("live_ind",), {"flag": 1.0}, flags), node(("std_claim",), {"flag": 1.0}, flags), node(("std_claim_cd",), {"flag": 1.0}, flags)
    group = lambda cols, conflicts=(), neighbours=(): len(set(schema_match.families(cols, [5] * len(cols), conflicts, neighbours)))
    assert group([live, std]) == 1 and group([live, std], neighbours=[(0, 1)]) == 2 and group([live, std], conflicts=[(0, 1)]) == 2
    assert group([std, claim], neighbours=[(0, 1)]) == 1 and group([live, std, claim], conflicts=[(0, 1), (0, 2)]) == 2
    words = {f"w:{i}": 0.25 for i in range(4)}
    owner, holder = node(("owner_nm",), {"text": 1.0}, words), node(("holder",), {"text": 1.0}, words)
    assert group([owner, holder], neighbours=[(0, 1)]) == 1 and group([owner, live]) == 2 and group([]) == 0


def test_pairs_in_arrays_score_as_one_by_one():
    draw = random.Random(3)
    made = lambda names: schema_match.ColumnNode(names, {draw.choice(["text", "date"]): 1.0}, {f"w:{draw.randrange(9)}": 0.25 for _ in range(4)} | {"d": 0.1})
    nodes = [made(names) for names in [("reg_dt",), ("registered_on", "reg_date"), ("",), ("owner_nm",), ("owner", "holder_nm", "hold"), ("dt",), ("date_reg",), ("x_1",)]]
    x, y, near = schema_match._pairs(nodes, [{0}, {0}, *[set()] * 6], [{1}, *[set()] * 4, {1}, set(), set()])
    pairs = list(zip(x.tolist(), y.tolist(), strict=True))
    assert pairs == sorted(set(pairs)) and (0, 1) not in pairs and len(pairs) > 10 and [p for p, n in zip(pairs, near, strict=True) if n] == [(0, 5)]
    likeness = schema_match._Likeness(nodes)
    holders = {p: sum(p in n.parts for n in nodes) for n in nodes for p in n.parts}
    names, values, _, kinds = likeness.of(nodes, x, y)
    one = lambda a, b: (schema_match.name_likeness(a, b, lambda p: holders.get(p, 1) ** -0.5), schema_match.shared(a.values, b.values, schema_match.SAYS), schema_match.shared(a.kinds, b.kinds))
    for found, (i, j) in zip(zip(names, values, kinds, strict=True), pairs, strict=True):
        assert found == pytest.approx(one(nodes[i], nodes[j]))
    graph = schema_match.PairGraph(nodes, x, y, likeness)
    scores = schema_match.column_scores(nodes, nodes, dict(zip(pairs, names.tolist(), strict=True)))
    assert schema_match.flood(graph.seeds(names), graph)["column"].tolist() == pytest.approx([scores[p] for p in pairs])
