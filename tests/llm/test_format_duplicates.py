"""Rows alike but for formatting, against a brute-force version."""

import collections
import random

import pytest

from lexloom.llm.format_duplicates import FormatDuplicates
from tests.conftest import rows

SCHEMA = "rid bigint, text string, year int, tags array<string>, fields map<string,string>, loaded string, id string, h1 bigint, n_copies int"


def canon(v):
    if isinstance(v, str):
        return "".join(c for c in v.lower() if c.isalnum())
    if isinstance(v, list):
        return ("L", tuple(sorted((canon(x) for x in v), key=repr)))
    if isinstance(v, dict):
        return ("M", tuple(sorted(((canon(k), canon(x)) for k, x in v.items()), key=repr)))
    return v


def brute(data):
    groups = collections.defaultdict(list)
    for r in data:
        groups[tuple(canon(v) for i, v in enumerate(r) if i not in (0, 5))].append(r[0])
    return sorted(((min(g), i) for g in groups.values() for i in g if i != min(g)), key=repr)


def made(n, seed):
    draw = random.Random(seed)
    return [(
        i, draw.choice(["Ab c", "AB-C", "abc", "ábc", "", None, "“Abc”", "ab\tc", "a b d"]), draw.choice([None, 1, 2]), draw.choice([None, [], ["x"], ["X ", "y"], ["y", "x"], ["x", "x"], [None], [""]]),
        draw.choice([None, {}, {"a": "1"}, {"A": " 1"}, {"a": None}, {"a": "1", "b": "2"}, {"b": "2", "a": "1"}]), str(i), "clash", 7, 9,
    ) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    data = made(1500, seed)
    found = FormatDuplicates(spark.createDataFrame(data, SCHEMA), "rid", ["loaded"])
    assert rows(found.members()) == brute(data)
    assert found.collisions().count() == 0
    groups = {r.rid: r.n_copies for r in found.collapsed().collect()}
    assert sum(groups.values()) == len(data) and all(g in groups for g, _ in brute(data))


def test_one_group_with_a_third_of_all_rows(spark):
    data = [(i, "Hot " + "-" * (i % 9) if i % 3 == 0 else f"n{i}", 1, None, None, "", "", 0, 0) for i in range(3000)]
    assert rows(FormatDuplicates(spark.createDataFrame(data, SCHEMA), "rid").members()) == brute(data)


def test_defined_cases(spark):
    same = (None, None, None, None, "", "", 0, 0)
    odd = spark.createDataFrame([(1, *same), (2, *same), (None, *same), (4, "x" * 3_000_000, *same[1:]), (5, "X" * 3_000_000 + "!", *same[1:])], SCHEMA)
    assert rows(FormatDuplicates(odd, "rid").members()) == [(1, 2), (4, 5)]
    unnamed = FormatDuplicates(spark.createDataFrame([(None, "A b", *same[1:]), (None, "ab", *same[1:]), (None, "c", *same[1:]), (7, "C", *same[1:])], SCHEMA), "rid").collapsed()
    assert sorted((r.rid or 0, r.n_copies, r.text) for r in unnamed.collect()) == [(0, 2, "A b"), (7, 2, "C")]
    assert FormatDuplicates(odd.limit(0), "rid").members().count() == 0 and FormatDuplicates(odd.limit(0), "rid").collapsed().count() == 0


def test_both_tables_are_collapsed_and_report_collisions(spark, folder):
    from lexloom.llm.queries import QUERIES

    kept, copies = QUERIES["p3_collapsed_records"](spark, folder), QUERIES["p3_found"](spark, folder).where("table_name = 'corpus_record'")
    total = spark.read.parquet(f"{folder}/corpus_record.parquet").count()
    assert kept.count() == total - copies.count() < total and kept.agg({"n_copies": "sum"}).first()[0] == total
    assert kept.join(copies, kept.record_id == copies.copy_id).count() == 0 and "text" in kept.columns
    assert QUERIES["p3_collisions"](spark, folder).count() == 0
