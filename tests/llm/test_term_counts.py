"""Counts by signed deltas against counting anew after every change."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from lexloom.llm import term_counts as tc

SCHEMA = "id bigint, word string, n bigint, term string, _n int"


def brute(rows):
    occurrences, records = collections.Counter(), collections.Counter()
    for r in set(rows):
        if r[1]:
            occurrences[r[1]] += r[2] or 0
            records[r[1]] += 1
    return {t: (occurrences[t], records[t]) for t in records}


def deltas(spark, before, after):
    """What changed between two states, through the change feed made of them."""
    frame = lambda rows: spark.createDataFrame(rows or [], SCHEMA)
    feed = tc.changed_rows(frame(before), frame(after), ["id", "word", "n"])
    return tc.change_deltas(feed, scope="s", sign=F.col("sign"), term=F.col("word"), occurrences=F.col("n"))


def of(store):
    return {r.term: (r.occurrences, r.records) for r in store.counts().collect()}


@pytest.mark.parametrize("bucket_rows", [1_000_000, 3])
def test_deltas_over_several_states_and_sessions(spark, bucket_rows):
    draw = random.Random(5)
    row = lambda i: (i, draw.choice(["a", "b", "hot", "hot", "hot", "", None, "längst", f"w{i % 17}"]), draw.choice([None, 0, 1, 5, -2]), "x", 1)
    state, before, path = [row(i) for i in range(80)], None, None
    for step in range(4):
        store = tc.TermCounts(spark, path, bucket_rows)  # opened again each time
        store.merge(deltas(spark, before, state))
        path = store.path
        assert of(tc.TermCounts(spark, path)) == of(store) == brute(state)
        assert sum(r["total"] for r in store.totals().collect()) == sum(n for n, _ in brute(state).values())
        for term in ("hot", "w3", "nowhere"):
            assert [(r.occurrences, r.records) for r in store.lookup(term).collect()] == [v for k, v in brute(state).items() if k == term]
        before, state = state, [row(r[0]) if draw.random() < 0.2 else r for r in state if draw.random() < 0.8] + [row(1000 * (step + 1) + i) for i in range(20)] + state[:3]


def test_only_changes_are_counted(spark):
    rows = [(i, "w", 1, "x", 1) for i in range(10)]
    found = deltas(spark, rows, [*rows[:-1], (9, "w", 4, "x", 1), (10, "v", 2, "x", 1)]).collect()
    assert {r.term: (r.occurrences, r.records) for r in found} == {"w": (3, 0), "v": (2, 1)}


def test_rows_delivered_twice_are_one_record(spark):
    feed = spark.createDataFrame([(1, "w", 2), (1, "w", 2), (2, "w", None), (2, "w", None), (3, "w", 2)], "id int, word string, n int")
    found = tc.change_deltas(feed, scope="s", sign=F.lit(1), term=F.col("word"), occurrences=F.col("n"), distinct=["id", "word", "n"]).first()
    assert (found.occurrences, found.records) == (4, 3)


def test_a_small_delta_leaves_the_large_run_alone(spark):
    store = tc.TermCounts(spark)
    store.merge(deltas(spark, None, [(i, f"w{i}", 1, "x", 1) for i in range(100)]))
    large = store.runs[0]["id"]
    store.merge(deltas(spark, None, [(1000, "w1", 1, "x", 1)]))
    assert [r["rows"] for r in store.runs] == [100, 1] and store.runs[0]["id"] == large
    store.merge(deltas(spark, None, [(2000 + i, f"v{i}", 1, "x", 1) for i in range(60)]))
    assert [r["rows"] for r in store.runs] == [160] and of(tc.TermCounts(spark, store.path))["w1"] == (2, 2)


def test_a_failed_merge_leaves_the_version_before_and_a_second_writer_is_refused(spark):
    store = tc.TermCounts(spark)
    store.merge(deltas(spark, None, [(1, "w", 1, "x", 1)]))
    other = tc.TermCounts(spark, store.path)
    broken = deltas(spark, None, [(2, "v", 1, "x", 1)]).withColumn("records", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        store.merge(broken)
    assert of(tc.TermCounts(spark, store.path)) == {"w": (1, 1)}
    other.merge(deltas(spark, None, [(2, "v", 1, "x", 1)]))
    with pytest.raises(RuntimeError, match="open it again"):
        store.merge(deltas(spark, None, [(3, "u", 1, "x", 1)]))
    assert of(tc.TermCounts(spark, store.path)) == {"w": (1, 1), "v": (1, 1)}


def test_everything_deleted_and_nothing_at_all(spark):
    store, rows = tc.TermCounts(spark), [(1, "w", 1, "x", 1)]
    store.merge(deltas(spark, None, []))
    assert store.counts().count() == 0
    store.merge(deltas(spark, None, rows))
    store.merge(deltas(spark, rows, []))
    assert store.counts().count() == 0 and tc.TermCounts(spark, store.path).runs == []


@pytest.mark.parametrize(("counts", "want"), [
    ([("a", 2), ("b", 3), ("c", 95)], {"a": "rare", "b": "common", "c": "common"}), ([("a", 1), ("b", 2), ("c", 147)], {"a": "rare", "b": "rare", "c": "common"}),
    ([("a", 3), ("c", 147)], {"a": "common", "c": "common"}), ([("a", 3), ("c", 148)], {"a": None, "c": "common"}), ([("a", 0), ("b", -1)], {"a": "rare", "b": "rare"}),
])
def test_verdicts(spark, counts, want):
    df = spark.createDataFrame([("s", t, n, 1) for t, n in counts], tc.COUNTS)
    assert {r.term: r.verdict for r in tc.verdicts(df).collect()} == want


def test_the_query_reads_a_store_opened_again(spark, folder, monkeypatch):
    from lexloom.llm import queries

    merges, merge = [], queries.term_counts.TermCounts.merge
    monkeypatch.setattr(queries.term_counts.TermCounts, "merge", lambda self, deltas: merges.append((id(self), self.version, deltas.isEmpty())) or merge(self, deltas))
    queries.p2_found(spark, folder)
    assert [m[1:] for m in merges] == [(0, False), (1, False), (2, False)]
