"""Mixtures: exact quotas, disjoint draws, caps, shares."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import mixture as mx
from tests.conftest import rows

DOCS, TARGETS = "doc_id bigint, text string, source string, block int, shard int", "source string, target_share double, max_repeats int"


def documents(spark, **n):
    draw = random.Random(7)
    out = [(i, " ".join(draw.choice(["law", "court", "of", "the", "appeal"]) for _ in range(draw.randrange(5, 60))), s, 1, 1) for i, s in enumerate(s for s, k in n.items() for _ in range(k))]
    return spark.createDataFrame([*out, (-1, None, "a", 1, 1), (-2, "", "a", 1, 1), (-3, "of the court", None, 1, 1), (None, "law", "other", 1, 1)], DOCS)


@pytest.fixture(scope="module")
def mixed(spark):
    docs = documents(spark, a=400, b=60, c=100, other=50)
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.4, 3), ("c", 0.2, 2), ("empty", 0.0, 1)], TARGETS)
    m = mx.Mixture(docs, targets, block_tokens=200, shard_tokens=1500)
    return docs, m, m.draws().collect()


def test_quotas_are_met_to_the_document(spark, mixed):
    docs, m, draws = mixed
    got, copies = collections.Counter(), collections.Counter()
    for r in draws:
        got[r.source] += r.n_tokens
        copies[r.source, r.doc_id] += 1
    largest = max(r.n_tokens for r in draws)
    for p in m.plan.itertuples():
        assert p.quota_tokens <= got[p.source] < p.quota_tokens + largest or got[p.source] == p.quota_tokens
    assert max(n for (s, _), n in copies.items() if s == "b") == 3 and max(n for (s, _), n in copies.items() if s == "a") == 1
    assert set(copies.values()) <= {1, 2, 3} and {s for s, _ in copies} == {"a", "b", "c"}
    assert len({(r.doc_id, r.copy_no) for r in draws}) == len(draws)  # each copy is drawn once, into one shard


def test_shards_are_alike_and_shuffled(mixed):
    _, m, draws = mixed
    by_shard = collections.defaultdict(list)
    for r in draws:
        by_shard[r.shard].append(r)
    assert len(by_shard) == m.plan.quota_tokens.sum() // 1500
    for shard in by_shard.values():
        assert sorted(r.place for r in shard) == list(range(1, len(shard) + 1))
    sources = ["".join(r.source for r in sorted(s, key=lambda r: r.place)) for s in by_shard.values()]
    assert any("ab" in s and "ba" in s for s in sources)  # not one source after another


def test_a_rerun_draws_the_same(spark, mixed):
    docs, m, draws = mixed
    again = mx.Mixture(docs.repartition(7), spark.createDataFrame([("c", 0.2, 2), ("b", 0.4, 3), ("a", 0.4, 1), ("empty", 0.0, 1)], TARGETS), block_tokens=200, shard_tokens=1500).draws()
    assert rows(again) == sorted((tuple(r) for r in draws), key=repr)


def test_report_and_reach(spark, mixed):
    docs, m, draws = mixed
    report = {r.source: r for r in m.report(spark.createDataFrame(draws)).collect()}
    assert math.isclose(sum(r.actual_share for r in report.values()), 1) and report["empty"].drawn_tokens == 0 and report["b"].most_copies == 3
    short = {r.source for r in mx.unreachable(m.report(spark.createDataFrame(draws))).collect()}
    assert short == {p.source for p in m.plan.itertuples() if p.max_repeats * p.size_tokens < p.target_share * m.size} == {"b"}


def test_exact_shares(spark, mixed):
    docs, m, _ = mixed
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.4, 3), ("c", 0.2, 2)], TARGETS)
    exact = mx.Mixture(docs, targets, exact=True, block_tokens=200)
    report = {r.source: r for r in exact.report(exact.draws()).collect()}
    assert exact.size < m.size and all(abs(r.actual_share - r.target_share) < 0.01 and r.most_copies <= r.max_repeats for r in report.values())


def test_the_tree_splits_exactly_and_anywhere():
    quotas = np.array([1000, 7, 0, 333])
    leaves = {s: (have, before) for s, have, before in mx.split_quotas(quotas, 17, 3)}
    sizes = [have.sum() for have, _ in leaves.values()]
    assert sum(have for have, _ in leaves.values()).tolist() == quotas.tolist() and max(sizes) - min(sizes) <= 1
    for s, (_, before) in leaves.items():
        assert before.tolist() == sum([leaves[k][0] for k in range(s)], np.zeros(4, int)).tolist()
    for first, last in ((0, 5), (5, 6), (6, 17)):
        assert all((leaves[s][0] == have).all() and (leaves[s][1] == before).all() for s, have, before in mx.split_quotas(quotas, 17, 3, first, last))


@pytest.mark.parametrize("at_once", [10**8, 5 * 10**8])
def test_draws_above_what_the_generator_takes_are_exact(at_once):
    have = np.array([3 * 10**9, 10**9 + 1, 5, 0])
    for n in (0, 1, 2 * 10**9 + 3, int(have.sum())):
        got = mx._draw(have, n, np.random.default_rng(1), at_once)
        assert got.sum() == n and (got >= 0).all() and (got <= have).all()
    half = mx._draw(have, 2 * 10**9, np.random.default_rng(2), at_once)
    assert abs(half[0] / have[0] - half[1] / have[1]) < 1e-3


def test_small_groups_draw_like_one(spark):
    """The same mean when the draw is made in groups."""
    have, n = np.array([40, 20, 10]), 35
    mean = lambda at_once: np.mean([mx._draw(have, n, np.random.default_rng(i), at_once) for i in range(800)], axis=0)
    assert np.abs(mean(7) - mean(10**6)).max() < 0.4 and np.abs(mean(7) - have / 2).max() < 0.4


def test_a_million_copies_of_a_small_source(spark):
    """Laid out in stretches by many tasks; each copy once, shares exact."""
    docs = spark.createDataFrame([(1, "of the court", "tiny", 1, 1), *[(10 + i, "of the court " * 40, "big", 1, 1) for i in range(200)]], DOCS)
    m = mx.Mixture(docs, spark.createDataFrame([("tiny", 0.9, 1_000_000), ("big", 0.1, 1)], TARGETS), size=1_000_000, n_shards=32, block_tokens=100)
    assert {r.rule: r.n_violations for r in m.violations().collect()} == dict.fromkeys(m_rules(spark), 0)
    tiny = m.draws().where("source = 'tiny'").agg(F.count("*"), F.max("copy_no")).first()
    assert tiny[0] == tiny[1] == m.plan.set_index("source").quota_tokens["tiny"] // 3


def m_rules(spark):
    from lexloom.llm import oracles
    from tools.compare import views

    return [r[0] for r in views("/nowhere").execute(oracles.ORACLES["p7_invariants"]).fetchall()]


def test_violations_are_seen(spark, mixed, monkeypatch):
    docs, m, draws = mixed
    found = lambda: {r.rule: r.n_violations for r in m.violations().collect() if r.n_violations}
    assert found() == {}
    twice = spark.createDataFrame([*draws, *[r for r in draws if r.source == "a"][:3]])
    monkeypatch.setattr(m, "draws", lambda: twice)
    assert {"document used no more than allowed", "no copy of a document twice", "places without gaps"} <= set(found())


def test_tokens_are_those_of_the_vocabulary(spark):
    texts = ["The court held that appeal 12 fails.", "", None, "  x\n\n y ", "é 東京 <|endoftext|>"]
    found = {r.doc_id: r.n_tokens for r in mx.token_counts(spark.createDataFrame([(i, t, "s", 1, 1) for i, t in enumerate(texts)], DOCS)).collect()}
    encoding = mx._encoding(mx.TOKENIZER)
    assert found == {i: len(encoding.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)} and found[0] > 5


def test_nothing(spark):
    targets = spark.createDataFrame([("a", 0.5, None), ("b", None, 2)], TARGETS)
    none = mx.Mixture(documents(spark, a=1).limit(0), targets)
    assert none.draws().count() == 0 and none.report(none.draws()).count() == 2 and mx.unreachable(none.report(none.draws())).count() == 0
    some = mx.Mixture(documents(spark, a=3), targets.limit(0))
    assert some.draws().count() == 0 and some.report(some.draws()).count() == 0
    short = mx.Mixture(documents(spark, a=3), targets)
    assert rows(mx.unreachable(short.report(short.draws()))) == [("a",)]
    assert documents(spark, a=1).where(F.col("doc_id") >= 0).count() == 1
