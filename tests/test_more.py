"""Properties with drawn inputs, and operators that the catalogue reaches only in part."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.phonetic import double_metaphone
from lexloom.operators import addressing, facts, licensing, phonology, scoring, screening
from lexloom.operators.holdout import canonical_names
from lexloom.sources import tolerant
from lexloom.sources.schema_match import rename_scores
from tests.conftest import rows

letters = st.text("abcdefghijklmnopqrstuvwxyz", max_size=14)


@given(st.lists(st.text(max_size=12), max_size=20))
def test_canonical_names_are_a_fixed_point(raw):
    once = canonical_names(raw)
    assert canonical_names(once) == once and list(once) == sorted(set(once))


@given(letters)
def test_codes_hold_only_sounds(word):
    assert set(double_metaphone(word)) <= set("APKFLNTXJSHMR0") and double_metaphone(word) == double_metaphone(word.upper())


@given(st.lists(st.sampled_from(["a_b", "c", "d_e", "b"]), min_size=1, max_size=4, unique=True), st.lists(st.sampled_from(["a_b", "x", "d", "b"]), min_size=1, max_size=4, unique=True))
def test_flooding_scores_are_bounded_and_alike_from_both_sides(old, new):
    a, b = [(c, "text") for c in old], [(c, "text") for c in new]
    seen = {(x, y): 0.5 for x in old for y in new if x != y}
    there, back = rename_scores(a, b, seen), rename_scores(b, a, {(y, x): v for (x, y), v in seen.items()})
    assert all(0 <= v <= 1 for v in there.values()) and all(abs(v - back[y, x]) < 1e-3 for (x, y), v in there.items())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from(["p", "q", "r"]), st.lists(st.sampled_from(["a", "b", "c", "d"]), min_size=1, max_size=4, unique=True), min_size=1))
def test_every_index_has_one_surface(spark, positions):
    size = 1
    for choices in positions.values():
        size *= len(choices)
    built = addressing.build(addressing.enumerate_range(spark, 0, size), positions)
    assert built.count() == size and built.where("surface is null").count() == 0 and addressing.duplicates(built).count() == 0


def test_subspaces_and_manifests(spark):
    space = {"a": ["x", "y", "z"], "b": ["1", "2"]}
    assert addressing.subspace(space, {"a": ["z", "x", "other"]}) == {"a": ["x", "z"], "b": ["1", "2"]}
    made = addressing.manifest(spark, "run-1", engine="1", seed="7").collect()
    assert {r.input for r in made} == {"engine", "seed"} and len({r.manifest_hash for r in made}) == 1


def test_unknown_fields_survive_a_round_trip(spark, tmp_path):
    lines = ['{"id": 1, "new": {"deep": [1, 2]}, "note": "say \\"x\\""}', '{"id": 2}', '{"id": 3, "flag": true, "n": null}', "no object"]
    (tmp_path / "in.json").write_text("\n".join(lines))
    known = T.StructType([T.StructField("id", T.LongType())])
    df = tolerant.read(spark, str(tmp_path / "in.json"), known)
    assert df.count() == 3 and df.where("id = 2").first()["extra"] == {}
    tolerant.write(df, str(tmp_path / "out"))
    back = sorted((json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()), key=lambda x: x["id"])
    assert back[0] == json.loads(lines[0]) and back[1] == {"id": 2} and back[2] == json.loads(lines[2])


def test_composition(spark):
    left = spark.createDataFrame([("l1", "lum", "root"), ("l2", "corva", "root")], "id string, form string, type string")
    right = spark.createDataFrame([("r1", "mex", "suffix"), ("r2", "ane", "suffix"), ("r3", "x", "other")], "id string, form string, type string")
    links = spark.createDataFrame([("root", "suffix", "o")], "left_type string, right_type string, linking_vowel string")
    assert {r.surface for r in phonology.compose(left, right, links).collect()} == {"lumomex", "lumane", "corvamex", "corvane"}


def test_lower_weights_of_used_morphemes(spark):
    m = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "id string, weight double")
    found = {r.id: r.weight for r in phonology.saturation_weight(m, spark.createDataFrame([("a", 50), ("a", 50)], "id string, brand_count int")).collect()}
    assert found["b"] == 1.0 and found["a"] < 0.2


def test_scopes_are_joined_late(spark):
    names = spark.createDataFrame([("n1", "f", "s", "d"), ("n2", "f", "t", "e")], "name_id string, phonoform_id string, surface string, derivation_id string")
    one = lambda key, k, v: spark.createDataFrame([(k, v)], f"{key} string, {key}_score double")
    found = scoring.by_scope(names, one("phonoform_id", "f", 1.0), one("surface", "s", 2.0), one("derivation_id", "e", 3.0))
    assert rows(found.select("name_id", "phonoform_id_score", "surface_score", "derivation_id_score")) == [("n1", 1.0, 2.0, None), ("n2", 1.0, None, 3.0)]


def test_forced_choice_against_chance(spark):
    df = spark.createDataFrame([("even", i % 2 == 0) for i in range(100)] + [("sure", i % 10 > 0) for i in range(100)], "arm string, is_right boolean")
    found = {r.arm: (r.accuracy, r.p_value) for r in scoring.forced_choice(df).collect()}
    assert found["even"][0] == 0.5 and found["even"][1] > 0.99 and found["sure"][1] < 1e-6


def test_screening_signals_have_no_verdict(spark):
    one = lambda *n: spark.createDataFrame([(x,) for x in n], "normalized string")
    found = screening.signals(one("corvane", "korvane", "zeprix"), one("corvane"))
    assert {(r.candidate, r.match_type) for r in found.collect()} == {("corvane", "exact"), ("korvane", "edit_distance"), ("korvane", "phonetic")}
    assert "verdict" not in found.columns and screening.signals(one(), one("a")).count() == 0


def test_lexicons_of_all_languages_gate(spark):
    lexicon = spark.createDataFrame([("Bad", "de", "blocking"), ("odd", "fr", "mild")], "word string, language string, severity string")
    names = spark.createDataFrame([("bad",), ("odd",), ("fine",)], "normalized string")
    assert rows(screening.lexicon_gate(names, lexicon)) == [("fine",), ("odd",)]


def test_cascade_and_order_of_checks(spark):
    c = spark.createDataFrame([("a", 0.9), ("b", 0.9), ("c", 0.1)], "normalized string, score double")
    taken = spark.createDataFrame([("a",), ("a",)], "name string")
    assert {r.normalized: r.level for r in facts.cascade(c, taken, 0.5).collect()} == {"a": "taken", "b": "promote", "c": "hold"}


def test_first_blend_entry_counts(spark):
    from lexloom.types import BlendEntry, CorpusBlend, Use

    blend = CorpusBlend("b", (BlendEntry("p", frozenset({Use.SATURATION}), 2.0), BlendEntry("p", frozenset({Use.DISPLAY}))))
    assert rows(licensing.blend_frame(spark, blend)) == [("b", "p", "saturation", 2.0)] and blend.providers(Use.DISPLAY) == frozenset() and blend.providers(Use.SATURATION) == {"p"}
    evidence = spark.createDataFrame([("n", "p", 3), ("n", "q", 5)], "normalized string, provider_id string, record_count int")
    assert rows(licensing.contributors(evidence, licensing.blend_frame(spark, blend), Use.SATURATION).select("provider_id", "weighted_count")) == [("p", 6.0)]
    assert licensing.contributors(evidence, licensing.blend_frame(spark, blend), "display").select(F.count("*")).first()[0] == 0
