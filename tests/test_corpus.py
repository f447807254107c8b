"""Rules, tags, evidence, licences, artifacts and their guards."""

import hashlib
import json

import pytest

from lexloom.errors import ArtifactSchemaError, AutophagyError, LicenceViolationError
from lexloom.operators import aggregate, artifact, licensing, normalise
from lexloom.sources.fixture import FixtureProvider
from lexloom.types import CORPUS_RECORD, BlendEntry, CorpusBlend, LicenceClass, ProviderDescriptor, ProviderKind, Use
from tests.conftest import rows


def records(spark, *texts, provider="p", status="live", year=None, fields=None):
    return spark.createDataFrame([(t, provider, f"r{i}", status, year, None, fields or {}) for i, t in enumerate(texts)], CORPUS_RECORD)


@pytest.mark.parametrize(("text", "rule"), [
    ("", "empty_text"), ("   ", "empty_text"), (None, "empty_text"), (" 　\t", "empty_text"), ("SOFT DRINKS", "multi_token"), ("soft drinks", "multi_token"),
    ("E*TRADE", "non_alphabetic"), ("CAFÉ", "non_alphabetic"), ("3M", "non_alphabetic"), ("name\n", None), ("XY", "too_short"), ("abc", None), ("a" * 16, None), ("a" * 17, "too_long"),
    ("SUPERCALIFRAGILISTIC", "too_long"), ("LLC", "legal_entity_artifact"), ("inc", "legal_entity_artifact"), ("co", "too_short"), ("INCEPTION", None), ("  Corvane  ", None), ("x" * 2_000_000, "too_long"),
])
def test_first_failing_rule(spark, text, rule):
    assert normalise.classified(records(spark, text)).first()["rejection_rule"] == rule


def test_funnel_of_the_fixture(spark, tmp_path):
    provider = FixtureProvider()
    found = normalise.funnel(provider.extract(spark, provider.acquire(tmp_path))).first()
    assert (found["extracted"], found["accepted"], found["distinct_names"], found["rejected_total"], found["acceptance_rate"]) == (8, 4, 4, 4, 0.5)
    assert [found[r] for r in ("multi_token", "non_alphabetic", "too_short", "legal_entity_artifact", "too_long", "empty_text")] == [1, 1, 1, 1, 0, 0]
    assert "too_short: 1" in normalise.render_funnel(found)
    assert normalise.funnel(records(spark)).count() == 0


def test_names_and_display(spark):
    found = normalise.normalise(records(spark, "CORVANE", "Corvane", " corvane "))
    assert {r.normalized for r in found.collect()} == {"corvane"} and {r.display for r in found.collect()} == {"CORVANE", "Corvane", "corvane"}


@pytest.mark.parametrize(("text", "status", "fields", "tags"), [
    ("APPLE", "unknown", {}, ["dictionary_word"]), ("BADWORD", None, {}, ["profanity_signal"]), ("BXTR", "??", {}, ["probable_acronym"]), ("CORVANE", " LIVE", {}, ["live_registration"]),
    ("MYTH", "dead", {}, ["abandoned"]), ("ONDARA", "unknown", {"international_registration": "true"}, ["international_registration"]), ("ONDARA", "unknown", {"international_registration": "1"}, ["international_registration"]), ("ONDARA", "unknown", {"international_registration": ""}, []),
])
def test_tags(spark, text, status, fields, tags):
    words = lambda w: spark.createDataFrame([(w,), (None,)], "word string")
    found = normalise.normalise(records(spark, text, status=status, fields=fields), words("Apple"), words("badword")).first()
    assert found["tags"] == tags


def test_evidence(spark):
    df = records(spark, "Corvane", "CORVANE", provider="a", year=2015).unionByName(records(spark, "corvane", provider="b", status="dead", year=1998)).unionByName(records(spark, "corvane", provider="b", status=None))
    evidence = aggregate.saturation(normalise.normalise(df))
    assert rows(evidence) == [("corvane", "a", 2, 2, 0, 2015, 2015), ("corvane", "b", 2, 0, 1, 1998, 1998)]
    assert rows(aggregate.convergence(evidence)) == [("corvane", 2, 4, 1998)]
    assert rows(aggregate.saturation(normalise.normalise(df.limit(0)))) == []


LICENCES = {
    "public_domain": "induction saturation novelty_reference evaluation display", "open_attribution": "induction saturation novelty_reference evaluation display",
    "commercial_licensed": "saturation novelty_reference display", "tos_restricted": "novelty_reference display", "internal_generated": "saturation novelty_reference", "unknown": "",
}


@pytest.mark.parametrize("licence", LICENCES)
def test_permissions(licence):
    assert {str(u) for u in licensing.permitted_uses(LicenceClass(licence))} == set(LICENCES[licence].split())
    d = ProviderDescriptor("p", "p", ProviderKind.CURATED, LicenceClass(licence))
    for use in Use:
        if str(use) in LICENCES[licence].split():
            licensing.require(d, use)
        else:
            with pytest.raises(LicenceViolationError, match="nothing" if licence == "unknown" else "permits"):
                licensing.require(d, use)


def test_permissions_are_read_only():
    with pytest.raises(TypeError):
        licensing.PERMITTED_USES[LicenceClass.UNKNOWN] = frozenset(Use)


def test_descriptors_are_checked():
    for bad in ({"id": ""}, {"id": "a b"}, {"trust_tier": 0}, {"trust_tier": 5}, {"attribution_required": True}):
        with pytest.raises(ValueError):
            ProviderDescriptor(**({"id": "p", "name": "p", "kind": ProviderKind.CURATED, "licence": LicenceClass.UNKNOWN} | bad))
    with pytest.raises(ValueError):
        BlendEntry("p", frozenset())
    with pytest.raises(ValueError):
        BlendEntry("p", frozenset(Use), 0)


def descriptor(name, licence="public_domain", kind="curated"):
    return ProviderDescriptor(name, name, ProviderKind(kind), LicenceClass(licence))


def blend(**roles):
    return CorpusBlend("b1", tuple(BlendEntry(p, frozenset({Use(r)})) for p, r in roles.items()))


def evidence(spark, **names):
    return spark.createDataFrame([(n, p) for p, ns in names.items() for n in ns.split()], "normalized string, provider_id string")


@pytest.mark.parametrize(("licence", "kind", "use", "error"), [
    ("commercial_licensed", "curated", "induction", LicenceViolationError), ("unknown", "curated", "saturation", LicenceViolationError), ("commercial_licensed", "curated", "saturation", None),
    ("internal_generated", "internal", "induction", LicenceViolationError), ("public_domain", "internal", "induction", AutophagyError), ("internal_generated", "internal", "saturation", None),
])
def test_gates(spark, licence, kind, use, error):
    make = lambda: artifact.build(Use(use), blend(a=use), [descriptor("a", licence, kind)], evidence(spark, a="corvane"))
    if error:
        with pytest.raises(error):
            make()
    else:
        assert rows(make().names) == [("corvane",)]


def test_blend_and_holdout(spark):
    ab = [descriptor("a"), descriptor("b")]
    held = spark.createDataFrame([("corvane",)], "normalized string")
    both = evidence(spark, a="corvane", b="lumeris")
    assert artifact.build(Use.INDUCTION, blend(a="induction", b="saturation"), ab, both).provider_ids == ("a",)
    assert rows(artifact.build(Use.INDUCTION, blend(a="induction", b="induction"), ab, both, held).names) == [("lumeris",)]
    twin = artifact.build(Use.INDUCTION, blend(a="induction"), ab, evidence(spark, a="korvane"), held)
    assert rows(twin.names) == [] and twin.excluded_by_holdout == {"phonetic": 1}
    assert rows(artifact.build(Use.SATURATION, blend(a="saturation"), ab, evidence(spark, a="corvane"), held).names) == [("corvane",)]


def test_round_trip_and_content_address(spark, tmp_path):
    made = artifact.build(Use.SATURATION, blend(a="saturation"), [descriptor("a")], evidence(spark, a="lumeris corvane corvane"))
    written = made.write(str(tmp_path / "a"))
    assert written == "sha256:" + hashlib.sha256(b"saturation|b1|corvane|lumeris").hexdigest()[:32]
    again = artifact.CorpusArtifact.read(spark, str(tmp_path / "a"))
    assert (again.artifact_id, again.provider_ids, again.use) == (written, ("a",), Use.SATURATION)


def test_guard_finds_everything(spark):
    held = spark.createDataFrame([("figma",)], "normalized string")
    artifacts = spark.createDataFrame([
        ("clean", "induction", ["a"], ["zeprix"]), ("dirty", "induction", ["a"], ["figma", "figmaa", "fikma", "zeprix", None]), ("saturated", "saturation", ["a"], ["figma"]),
        ("who", "display", ["nobody"], []), ("tos", "induction", ["t"], None), ("own", "induction", ["i", "i"], []),
    ], "artifact_id string, use_kind string, provider_ids array<string>, names array<string>")
    known = licensing.descriptors_frame(spark, [descriptor("a"), descriptor("t", "tos_restricted"), descriptor("i", "public_domain", "internal")])
    found = {(r.artifact_id, r.violation) for r in artifact.check(artifacts, known, held).collect()}
    assert found == {("dirty", "contaminated"), ("who", "unknown_provider"), ("tos", "licence"), ("own", "autophagy")}
    none = {(r.artifact_id, r.violation) for r in artifact.check(artifacts, known, None).collect()}
    assert {a for a, v in none if v == "no_holdout"} == {"clean", "dirty", "tos", "own"}


def test_command_line_guard(spark, tmp_path, capsys):
    from lexloom.cli import check_corpus
    from lexloom.operators.holdout import seal
    from lexloom.types import CorpusPaths

    paths = CorpusPaths(tmp_path / "artifacts", tmp_path / "holdout")
    assert check_corpus(paths) == 1
    paths.artifacts.mkdir()
    paths.holdout.mkdir()
    assert check_corpus(paths) == 0
    body = {"artifact_id": "x", "use": "induction", "blend_id": "b", "provider_ids": ["uspto.case_files"], "names": ["zeprix", "lumeris"]}
    artifact.write_json(body, paths.artifacts / "one.json")
    assert check_corpus(paths) == 1  # no holdout
    names = ["figma"] + [f"pad{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    (paths.holdout / "holdout.txt").write_text("\n".join(names))
    assert check_corpus(paths) == 1  # no seal
    (paths.holdout / "holdout.sealed.json").write_text(seal(names).to_json())
    assert check_corpus(paths) == 0
    artifact.write_json(body | {"artifact_id": "y", "names": ["figmaa"]}, paths.artifacts / "two.json")
    assert check_corpus(paths) == 1 and "figmaa" in capsys.readouterr().out
    (paths.artifacts / "two.json").write_text(json.dumps({"schema": 100}))
    with pytest.raises(ArtifactSchemaError):
        check_corpus(paths)


def test_from_snapshots_to_an_artifact(spark, tmp_path):
    from lexloom import api
    from lexloom.errors import SnapshotValidationError
    from lexloom.operators.ledger import SnapshotLedger

    one, two = FixtureProvider("one"), FixtureProvider("two", names=[("Corvane", "dead"), ("Novum", "live")])
    assert isinstance(one, api.CorpusProvider)
    book = SnapshotLedger(tmp_path / "ledger.json")
    results = [api.ingest(spark, p, p.acquire(tmp_path), ledger=book) for p in (one, two)]
    assert [r.report.first()["accepted"] for r in results] == [4, 2] and len(book.rows()) == 2
    held = spark.createDataFrame([("zeprix",)], "normalized string")
    made = api.build_artifact(Use.INDUCTION, blend(one="induction", two="induction"), results, held)
    assert rows(made.names) == [("corvane",), ("lumeris",), ("novum",), ("ondara",)] and made.excluded_by_holdout == {"exact": 1}
    with pytest.raises(SnapshotValidationError):
        api.ingest(spark, FixtureProvider("one", names=[("X", "live")]), FixtureProvider("one", names=[("X", "live")]).acquire(tmp_path), ledger=book)
