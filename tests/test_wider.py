"""Membership filters, promotion, ownability, explanations, tenants, replayed ledgers, quantiles; against plain versions."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexloom.operators import facts, ledger, membership, ordering, scoring, screening
from tests.conftest import rows


def test_filter_misses_nothing_and_lets_few_through(spark):
    names = spark.range(20_000).select(F.concat(F.lit("n"), "id").alias("name"))
    inside, blocks = names.where("substring(name, 2) < '5'"), membership.blocks_for(15_000)
    bloom = membership.bloom_filter(inside.unionByName(inside).repartition(7), "name", blocks)
    asked = membership.might_hold(names.withColumn("w0", F.lit("clash")).drop("w0"), "name", bloom, blocks)
    truth = asked.join(inside.withColumn("is_in", F.lit(True)), "name", "left")
    assert truth.where("is_in and not might_hold").count() == 0
    assert truth.where("is_in is null and might_hold").count() < 0.005 * truth.where("is_in is null").count()


def test_filter_of_nothing_and_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("",)], "name string")
    none = membership.bloom_filter(df.limit(0), "name", 1)
    assert rows(membership.might_hold(df, "name", none, 1)) == sorted([("a", False), (None, False), ("", False)], key=repr)
    some = membership.bloom_filter(df, "name", 1)
    assert {r.name: r.might_hold for r in membership.might_hold(df, "name", some, 1).collect()} == {"a": True, None: False, "": True}


def test_hints_never_decide(spark):
    c = spark.createDataFrame([("a", 0.9), ("b", 0.9), ("c", 0.1), ("d", 0.9), ("e", None)], "normalized string, score double")
    known = spark.createDataFrame([("b", "dns", "registered", 0.9), ("d", "dns", "free", 0.9), ("d", "registrar", "registered", 0.2), ("c", "registrar", "free", 1.0)], "normalized string, source string, status string, confidence double")
    found = {r.normalized: (r.level, r.hint, r.verdict) for r in facts.promote(c, spark.createDataFrame([("a",), ("a",)], "name string"), known, 0.5, ["registrar"]).collect()}
    assert found == {"a": ("L0", None, "taken"), "b": ("L2", "registered", None), "c": ("L1", None, None), "d": ("L3", "free", "taken"), "e": ("L2", None, None)}


def test_ownability_leaves_out_what_is_not_known(spark):
    df = spark.createDataFrame([("a", 4, 2, 0, 0, 0), ("b", 0, 0, None, None, None)], "name string, n_domains int, n_free int, cost_cents int, n_handles int, n_free_handles int")
    found = {r.name: r.ownability for r in facts.ownability(df, {"availability": 1.0, "cost": 1.0, "handles": 5.0}).collect()}
    assert found == {"a": 0.75, "b": None}


def test_parts_of_an_explanation_add_up(spark):
    df = spark.createDataFrame([(1, 0.5, 1.0), (2, None, 0.4)], "id int, fit double, novelty double")
    origins = {"composite": ("view", "w", "1"), "fit": ("score", "x", "2"), "novelty": ("score", "y", "3")}
    found = scoring.explain(df, ["id"], {"fit": 3.0, "novelty": 1.0}, origins).collect()
    for i, whole in ((1, 0.625), (2, 0.4)):
        mine = [r for r in found if r.id == i]
        assert next(r.value for r in mine if r.number == "composite") == pytest.approx(whole) == pytest.approx(sum(r.part for r in mine if r.part is not None))
    assert {(r.number, r.layer, r.writer, r.version) for r in found} == {(k, *v) for k, v in origins.items()}
    with pytest.raises(ValueError, match="novelty"):
        scoring.explain(df, ["id"], {"novelty": 1.0}, {"composite": ("a", "b", "c")})


def test_tenants_are_apart(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "organization_id string, n int")
    facts.write_by_tenant(df, str(tmp_path / "t"))
    mine = facts.read_of_tenant(spark, str(tmp_path / "t"), "a")
    assert [r.n for r in mine.collect()] == [1] and "PartitionFilters: [isnotnull(organization_id" in mine._jdf.queryExecution().toString()
    with pytest.raises(PySparkException, match="no organization"):
        facts.write_by_tenant(spark.createDataFrame([(None, 1)], "organization_id string, n int"), str(tmp_path / "u"))


def test_refused_deliveries_are_no_measure(spark):
    df = spark.createDataFrame([(1, "a", 100), (2, "a", 50), (3, "a", 60), (4, "a", 95), (5, "a", 86), (6, "b", None), (7, "b", 5), (8, "a", 85)], "ledger_seq bigint, provider_id string, byte_size bigint")
    assert {r.ledger_seq: r.accepted for r in ledger.replayed(df).collect()} == {1: True, 2: False, 3: False, 4: True, 5: True, 6: True, 7: True, 8: True}


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_quantiles(spark, q):
    values = [float(x) for x in np.random.default_rng(3).integers(0, 50, 301)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    assert ordering.quantile(df, "v", q, "x").first()[0] == pytest.approx(np.quantile(values, q))
    assert ordering.quantile(df.limit(0), "v", q, "x").first()[0] is None


def test_running_totals_of_several_amounts(spark):
    df = spark.createDataFrame([(k, k * 2) for k in range(50)] + [(None, 7)], "x int, n int")
    found = {r.x: (r.a, r.b) for r in ordering.running_totals(df, "x", {"a": F.col("n"), "b": F.lit(1)}).collect()}
    assert found[None] == (0, 0) and found[0] == (7, 1) and found[10] == (7 + sum(range(0, 20, 2)), 11)


def test_postures_in_blocks(spark, monkeypatch):
    v = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "id int, embedding array<double>")
    p = spark.createDataFrame([(f"p{i}", [float(i), 1.0]) for i in range(23)], "posture string, centroid array<double>")
    whole = rows(scoring.posture_fit(v, p).select("id", "posture", F.round("fit", 9)))
    monkeypatch.setattr(scoring, "MAX_POSTURES", 4)
    assert rows(scoring.posture_fit(v, p).select("id", "posture", F.round("fit", 9))) == whole and len(whole) == 115


@pytest.mark.parametrize("days", [1, 30, 400_000])
def test_facts_of_any_life(spark, days):
    import datetime as dt

    start = dt.datetime(2020, 1, 1)
    until = lambda i: min(start + dt.timedelta(days=i) + dt.timedelta(days=days), dt.datetime(9999, 12, 31))
    known = [(i % 3, f"s{i}", "free", float(i * 7 % 11), start + dt.timedelta(days=i, hours=i), until(i)) for i in range(40)]
    f = spark.createDataFrame(known, "candidate_id int, source string, status string, confidence double, checked_at timestamp, expires_at timestamp")
    asked = [(i, i % 3, start + dt.timedelta(days=i * 3, hours=5)) for i in range(30)]
    d = spark.createDataFrame(asked, "decision_id int, candidate_id int, decided_at timestamp")
    found = {r.decision_id: r.source for r in facts.facts_at_decisions(f, d).collect()}
    plain = {}
    for i, c, at in asked:
        met = [(k[3], k[4], k[1]) for k in known if k[0] == c and k[4] <= at < k[5]]
        if met:
            plain[i] = max(met)[2]
    assert found == plain


def test_collisions_by_word_and_sound(spark):
    n = lambda *x: spark.createDataFrame([(v,) for v in x], "normalized string")
    found = {r.normalized: r.collides for r in screening.collision_gate(n("figma", "phigma", "lumeris"), n("figma", None, "figma")).collect()}
    assert found == {"figma": "word", "phigma": "sound", "lumeris": None}
    assert screening.collision_gate(n("a").limit(0), n("b")).count() == 0
    signals = spark.createDataFrame([("c", "m", "exact", 1.0), ("c", "k", "exact", 0.5)], "candidate string, mark string, match_type string, similarity double")
    classes = spark.createDataFrame([("m", "9"), ("m", "9"), ("m", "42"), ("k", None)], "mark string, class string")
    assert rows(screening.signal_counts_by_class(signals, classes)) == [("c", "exact", "42", 1, 1.0), ("c", "exact", "9", 1, 1.0), ("c", "exact", "none", 1, 0.5)]
