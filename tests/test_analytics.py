"""Measures, facts, enumeration, phonology and streams on small cases."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.functions.phonetic import double_metaphone
from lexloom.operators import addressing, evaluation, facts, ordering, phonology, scoring, screening
from lexloom.plans import reference
from lexloom.plans.reference import QUERIES
from lexloom.streaming import facts as streams
from tests.conftest import rows


def names(spark, *n):
    return spark.createDataFrame([(x,) for x in n], "normalized string")


def test_running_total_over_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"), (F.col("id") % 3).alias("n"))
    found = {r.x: r.before for r in ordering.running_total(df, "x", F.col("n"), "before").collect()}
    total, want = 0, {}
    for x, n in sorted((r.x, r.n) for r in df.collect()):
        want[x] = total
        total += n
    assert found == want
    assert ordering.running_total(df.limit(0), "x", F.col("n"), "before").count() == 0


def test_rank_within_groups(spark):
    df = spark.createDataFrame([("a", 3), ("a", 5), ("a", 5), ("a", None), ("b", 1), (None, 2), (None, 2), (None, 1)], "g string, v int")
    assert rows(ordering.grouped_rank(df, "g", "v", "rank")) == rows(df.withColumn("rank", F.expr("rank() over (partition by g order by v desc nulls last)")))


def test_kneser_ney_sums_to_one(spark):
    training = names(spark, "aba", "abb", "bab", "aab")
    # after "^a" in a 3-gram model: all next characters' probabilities
    scored = evaluation.kneser_ney(names(spark, "aba", "zzz"), training, n=3).collect()
    found = {r.normalized: r.mean_log_prob for r in scored}
    assert found["aba"] > found["zzz"] and all(math.isfinite(v) for v in found.values())


def test_gini_entropy_agreement(spark):
    assert evaluation.gini(spark.createDataFrame([(1.0,), (1.0,), (1.0,)], "v double"), "v").first()[0] == pytest.approx(0)
    assert evaluation.gini(spark.createDataFrame([(0.0,), (0.0,), (9.0,)], "v double"), "v").first()[0] == pytest.approx(2 / 3)
    assert evaluation.gini(spark.createDataFrame([], "v double"), "v").first()[0] == 0
    assert evaluation.entropy(spark.createDataFrame([("g", v) for v in "aabb"], "g string, v string"), "g", "v").first()[1] == pytest.approx(1)
    perfect = spark.createDataFrame([(u, u) for u in (1, 2, 3) for _ in range(2)], "u int, v int")
    assert evaluation.krippendorff_alpha(perfect, "u", "v").first()[0] == pytest.approx(1)
    assert evaluation.spearman(spark.createDataFrame([(1, 1), (2, 4), (3, 9)], "a int, b int"), "a", "b").first()[0] == pytest.approx(1)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_every_name_has_its_distance(spark):
    candidates, corpus = ["corvane", "fgima", "ab", "a" * 20, "123", "quixzotl"], ["ab", "a" * 19 + "b", "korvanne", "lumexxis", "mandor"]
    found = {r.normalized: r for r in screening.novelty_distances(names(spark, *candidates), names(spark, *corpus)).collect()}
    letters = {n: min(edits(n, c) for c in corpus) for n in candidates}
    sounds = {n: min(edits(double_metaphone(n), double_metaphone(c)) for c in corpus) if double_metaphone(n) else None for n in candidates}
    assert {n: r.edit_distance for n, r in found.items()} == letters and {n: r.phonetic_distance for n, r in found.items()} == sounds
    assert letters["ab"] == 0 and letters["a" * 20] == 1 and letters["quixzotl"] > 4
    (row,) = screening.novelty_summary(screening.novelty_distances(names(spark, *candidates), names(spark, *corpus))).collect()
    assert row.n_names == 6 and row.edit_least == 0 and row.edit_p95 == np.percentile(list(letters.values()), 95)
    assert {r.edit_distance for r in screening.novelty_distances(names(spark, *candidates), names(spark, "x").limit(0)).collect()} == {None}


def test_novelty_is_the_least_distance(spark):
    corpus = ["corvane", "figma", "lumeris", "abc", "zeprix"]
    found = {r.normalized: r.min_distance for r in screening.distances_within(names(spark, "corvane", "korvanne", "fgima", "xyz", "ab", "lumexxis"), names(spark, *corpus)).collect()}
    assert found == {"corvane": 0, "korvanne": 2, "fgima": 2, "xyz": None, "ab": None, "lumexxis": 2}


def test_whole_operators_are_registered(spark, folder, monkeypatch):
    scores = QUERIES["name_scores"](spark, folder).collect()
    signs = lambda n: (n[0] in n[1:]) + (len(n) <= 8) + any(n[i : i + 2] in n[i + 2 :] for i in range(len(n) - 3))
    assert all(r.memorable == pytest.approx(signs(r.normalized) / 3, abs=1e-6) for r in scores)
    assert QUERIES["lexical_mutations"](spark, folder).groupBy("normalized").count().agg(F.max("count")).first()[0] == 3
    monkeypatch.setattr(reference, "_accepted", lambda *_: names(spark, "phonixel"))
    monkeypatch.setattr(reference, "_held", lambda *_: names(spark, "fonicksel"))
    assert [r.match_type for r in QUERIES["screening_all_signals"](spark, folder).collect()] == ["phonetic"]


def test_confusables(spark):
    assert rows(screening.confusables(names(spark, "modern", "modem", "other", "modem"))) == [("modem", "modem"), ("modem", "modern")]


def fact(c, source, conf, at, days):
    return (c, source, "free", conf, dt.datetime(2030, 1, at), dt.datetime(2030, 1, at) + dt.timedelta(days=days))


def test_facts(spark):
    df = spark.createDataFrame([fact(1, "dns", 0.4, 1, 20), fact(1, "whois", 0.9, 2, 3), fact(1, "whois", 0.8, 9, 20)], "candidate_id int, source string, status string, confidence double, checked_at timestamp, expires_at timestamp")
    when = lambda d: F.lit(dt.datetime(2030, 1, d))
    assert [facts.best_facts(df, when(d)).first()["confidence"] for d in (1, 3, 6, 10)] == [0.4, 0.9, 0.4, 0.8]
    decisions = spark.createDataFrame([(7, 1, dt.datetime(2030, 1, 3)), (8, 1, dt.datetime(2029, 1, 1))], "decision_id int, candidate_id int, decided_at timestamp")
    assert [(r.decision_id, r.confidence) for r in facts.facts_at_decisions(df, decisions).collect()] == [(7, 0.9)]


def test_facts_at_decisions_against_every_pair(spark):
    import random

    draw = random.Random(4)
    moment = lambda: dt.datetime(2030, 1, 1) + dt.timedelta(minutes=30 * draw.randrange(0, 48 * 6))
    known = []
    for _ in range(300):
        start = moment()
        known.append((draw.randrange(3), draw.choice("ab"), "s", float(draw.randrange(5)), start, start + dt.timedelta(minutes=30 * draw.randrange(-2, 200))))
    asked = [(i, draw.randrange(4), moment()) for i in range(120)] + [(900, None, moment()), (901, 1, None)]
    best = {}
    for d, c, when in asked:
        readable = [(f[3], f[4], f[1]) for f in known if f[0] == c and when and f[4] <= when < f[5]]
        if readable:
            best[d] = max(readable)
    facts_frame = spark.createDataFrame(known, "candidate_id int, source string, status string, confidence double, checked_at timestamp, expires_at timestamp")
    decisions = spark.createDataFrame(asked, "decision_id int, candidate_id int, decided_at timestamp")
    for width in (3600, 86_400):
        found = facts.facts_at_decisions(facts_frame, decisions, width)
        assert {r.decision_id: (r.confidence, r.checked_at, r.source) for r in found.collect()} == best


def test_feistel_is_a_bijection_and_shards_agree(spark):
    for size in (1, 2, 3, 10, 1000, 4096):
        assert sorted(addressing.permute(np.arange(size), size, 5)) == list(range(size))
    positions = {"a": ["x", "y"], "b": ["1", "2", "3"]}
    whole = addressing.build(addressing.enumerate_range(spark, 0, 6), positions, key=3)
    assert addressing.duplicates(whole).count() == 0
    halves = addressing.build(addressing.enumerate_range(spark, 0, 4), positions, key=3).unionByName(addressing.build(addressing.enumerate_range(spark, 4, 6), positions, key=3))
    assert addressing.fingerprint(whole).first() == addressing.fingerprint(halves).first()
    assert addressing.replay_failures(whole, positions, key=3).count() == 0 and addressing.replay_failures(whole, positions, key=4).count() > 0
    assert addressing.compatible({"a": ["x"]}, {"a": ["x"]}) and not addressing.compatible({"a": ["x"]}, {"a": ["x", "y"]})
    assert addressing.space_id({"a": 1}) != addressing.space_id({"a": 2})


def test_decode_encode(spark):
    df = spark.range(60).withColumnRenamed("id", "idx")
    digits = addressing.decode(F.col("idx"), [3, 4, 5])
    assert df.where(addressing.encode(digits, [3, 4, 5]) != F.col("idx")).count() == 0


def test_slots_add_up(spark):
    w = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0)], "choice string, weight double")
    found = addressing.slots(w)
    assert sum(r.n_slots for r in found.collect()) == 1024 and addressing.slot_table(found).count() == 1024


def test_phonology(spark):
    df = spark.createDataFrame([(list("pra"), list("pr")), (list("rpa"), list("rp")), (list("aata"), []), (list("astra"), ["s"])], "p array<string>, onset array<string>")
    found = df.select(phonology.sonority_rises(F.col("onset"), phonology.TOY), phonology.no_repeat(F.col("p")), phonology.clusters_within(F.col("p"), phonology.TOY), phonology.no_hiatus(F.col("p"), phonology.TOY)).collect()
    assert [tuple(r) for r in found] == [(True, True, True, True), (False, True, True, True), (True, False, True, False), (True, True, False, True)]
    v = spark.createDataFrame([("f", f"s{i}", float(i), 1, "r") for i in range(12)], "phonoform_id string, surface string, fidelity double, frequency int, register string")
    assert [r.surface for r in phonology.top_variants(v).orderBy("rank").collect()] == [f"s{i}" for i in range(11, 3, -1)]


def test_scores(spark):
    df = spark.createDataFrame([("n", 0.8, None), ("m", 0.5, 1.0)], "name string, a double, b double")
    assert {r.name: round(r.composite, 3) for r in scoring.composite(df, {"a": 1.0, "b": 3.0}).collect()} == {"n": 0.8, "m": 0.875}
    basket = spark.createDataFrame([("x", 0.9, 1.0), ("x", 0.5, 3.0), ("y", 0.9, 1.0), ("y", 0.1, 1.0)], "item string, s double, w double")
    assert {r.item: r.basket_score for r in scoring.market_basket(basket, "item", "s", "w", 0.3).collect()} == {"x": 0.6, "y": None}
    assert spark.range(1).select(scoring.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))).first()[0] is None


def test_stream_equals_batch(spark, tmp_path):
    data = spark.createDataFrame([(i % 5, "s", "free", float(i * 37 % 11), dt.datetime(2030, 1, 1) + dt.timedelta(minutes=i)) for i in range(60)], "candidate_id int, source string, status string, confidence double, checked_at timestamp")
    source = str(tmp_path / "in")
    data.repartition(3).write.parquet(source)
    stream = lambda: spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(source)
    running = streams.upsert_best(stream(), str(tmp_path / "best"), str(tmp_path / "state"))
    running.awaitTermination()
    found = {r.candidate_id: r.confidence for r in streams.best_so_far(spark, str(tmp_path / "best")).collect()}
    streams.compact(spark, str(tmp_path / "best"), str(tmp_path / "compact"))
    assert rows(streams.best_so_far(spark, str(tmp_path / "compact"))) == rows(streams.best_so_far(spark, str(tmp_path / "best")))
    assert max(p["batchId"] for p in running.recentProgress) == 2 and found == {r.candidate_id: r.m for r in data.groupBy("candidate_id").agg(F.max("confidence").alias("m")).collect()}
    history = streams.append_history(stream(), str(tmp_path / "history"), str(tmp_path / "state2"))
    history.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "history")).count() == 60
