"""Ledger, inventory, configuration and the readers of files."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from lexloom import cli, config
from lexloom.errors import AcquisitionError, CorpusConfigError, SchemaContractError, SnapshotValidationError
from lexloom.operators import inventory, ledger
from lexloom.sources import fixture, registry_csv
from lexloom.types import LEDGER, Snapshot
from tests.conftest import rows


def snapshot(path: Path, size: int, provider="alpha"):
    path.write_bytes(b"x" * size)
    return Snapshot(provider, ledger.compute_content_hash(path), path, size, "v")


@pytest.mark.parametrize(("before", "now", "tolerance", "ok"), [
    (10_000, 4_000, 0.1, False), (10_000, 9_500, 0.1, True), (10_000, 50_000, 0.1, True), (10_000, 8_000, 0.5, True), (10_000, 8_000, 0.05, False), (None, 1, 0.1, True), (10_000, 9_000, 0.1, True),
])
def test_truncation(tmp_path, before, now, tolerance, ok):
    snap = snapshot(tmp_path / "f", now)
    if ok:
        ledger.validate_against_previous(snap, before, tolerance)
    else:
        with pytest.raises(SnapshotValidationError, match="shrank"):
            ledger.validate_against_previous(snap, before, tolerance)


def test_ledger(tmp_path):
    book = ledger.SnapshotLedger(tmp_path / "ledger.json")
    assert book.latest("alpha") is None
    for provider, size in (("alpha", 100), ("beta", 200), ("alpha", 300)):
        book.accept(snapshot(tmp_path / f"{provider}{size}", size, provider))
    assert book.latest("alpha")["byte_size"] == 300
    with pytest.raises(SnapshotValidationError):
        book.accept(snapshot(tmp_path / "small", 10))
    assert book.latest("alpha")["byte_size"] == 300
    (tmp_path / "ledger.json").write_text('{"no": "list"}')
    assert book.rows() == []


def test_integrity(tmp_path):
    good = snapshot(tmp_path / "f", 10)
    ledger.verify_integrity(good)
    (tmp_path / "f").write_bytes(b"y" * 10)
    with pytest.raises(SnapshotValidationError, match="hash"):
        ledger.verify_integrity(good)
    (tmp_path / "f").write_bytes(b"y")
    with pytest.raises(SnapshotValidationError, match="bytes"):
        ledger.verify_integrity(good)
    (tmp_path / "f").unlink()
    with pytest.raises(SnapshotValidationError, match="exist"):
        ledger.verify_integrity(good)


def test_ledger_frames(spark):
    df = spark.createDataFrame([(1, "a", "h", 100, "v1", "2030-01-05T00:00:00Z"), (2, "b", "h", 50, "v1", "2030-01-01T00:00:00+00:00"), (3, "a", "h", 80, "v2", "2029-01-01T00:00:00Z"), (4, "a", "h", None, "v3", None)], LEDGER)
    assert {(r.provider_id, r.vintage) for r in ledger.latest(df).collect()} == {("a", "v3"), ("b", "v1")}
    assert [(r.ledger_seq, r.previous_size) for r in ledger.truncations(df).collect()] == [(3, 100)]
    assert {(r.provider_id, r.age_days) for r in ledger.freshness(df, "2030-01-10").collect()} == {("a", 5), ("b", 9)}


ENTRIES = [{"id": "mor.lat.corv", "phonemic": "korv", "weight": 0.4, "gloss": "raven"}, {"id": "mor.lat.lum", "phonemic": "lum", "weight": 0.9, "gloss": "light"}, {"id": "mor.aff.ane", "phonemic": "ein", "weight": 0.3, "gloss": "suffix"}]


def changed(i, **kw):
    return [e | kw if k == i else e for k, e in enumerate(ENTRIES)]


@pytest.mark.parametrize(("entries", "n"), [
    (ENTRIES, 0), (ENTRIES + [{"id": "new"}], 0), (changed(0, gloss="other", status="x"), 0), ([dict(reversed(e.items())) for e in ENTRIES], 0),
    ([ENTRIES[0], ENTRIES[2]], 3), ([ENTRIES[1], ENTRIES[0], ENTRIES[2]], 2), (ENTRIES[:2], 2), (changed(1, weight=0.5), 1), (changed(1, semantics={"valence": 1}), 1),
])
def test_inventory_breaches(spark, entries, n):
    assert len(inventory.compare(spark, "i", entries, inventory.build_lock(ENTRIES))) == n


def test_inventory_files(spark, tmp_path, capsys):
    assert cli.main(["inventory-lock", "check", "--root", str(tmp_path / "none")]) == 0
    (tmp_path / "deep").mkdir()
    path = tmp_path / "deep" / "i.yaml"
    path.write_text("- id: a\n  weight: 1\n- id: b\n")
    assert cli.main(["inventory-lock", "check", "--root", str(tmp_path)]) == 1
    assert cli.main(["inventory-lock", "update", "--root", str(tmp_path)]) == 0
    assert cli.main(["inventory-lock", "check", "--root", str(tmp_path)]) == 0
    path.write_text("- id: z\n- {id: b, weight: 1}\n- id: c\n")
    lock = {"schema": 1, "entries": inventory.build_lock([{"id": "a"}, {"id": "b"}])["entries"]}
    assert len(inventory.compare(spark, path, inventory.load_entries(path), lock)) == 2
    assert len(inventory.compare(spark, path, [], {"schema": 2})) == 1
    for bad in ("id: a", "- id: a\n- id: a", "- x: 1", "- 1"):
        path.write_text(bad)
        with pytest.raises(ValueError):
            inventory.load_entries(path)
    path.write_text("")
    assert inventory.load_entries(path) == []


def test_config(tmp_path):
    assert config.resolve(tmp_path).artifacts == tmp_path / "data/corpus/artifacts"
    write = lambda line: (tmp_path / "pyproject.toml").write_text(f"[tool.lexloom.corpus]\n{line}\n")
    write('artifacts = "elsewhere"')
    assert config.resolve(tmp_path).artifacts == tmp_path / "elsewhere"
    for bad in ('artifacts = " "', 'holdout = "/abs"', "holdout = 3"):
        write(bad)
        with pytest.raises(CorpusConfigError):
            config.resolve(tmp_path)
    write("")
    with pytest.raises(CorpusConfigError):
        config.require_artifacts_dir(config.resolve(tmp_path))


HEADER = "serial_no,mark_id_char,mark_draw_cd,filing_dt,status_cd,live_dead_ind"
LINES = ["78000001,CORVANE,4,20110402,700,L", "78000002,LUMERIS,5,20190115,700,?", "78000003,SWOOSH LOGO,2,20050101,700,L", "78000004,ZEPRIX,5,not-a-date,606,D", "78000005,,4,20200601,700,L"]


def csv(tmp_path, header=HEADER, lines=LINES):
    path = tmp_path / "r.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


@pytest.mark.parametrize("header", [HEADER, HEADER.upper(), "serial_number,mark_identification,mark_drawing_code,filing_date,status_code,live_dead_indicator"])
def test_registry(spark, tmp_path, header):
    found = {r.text: (r.status, r.first_seen_year, r.source_ref) for r in registry_csv.read(spark, csv(tmp_path, header)).collect()}
    assert found == {"CORVANE": ("live", 2011, "78000001"), "LUMERIS": ("unknown", 2019, "78000002"), "ZEPRIX": ("dead", None, "78000004")}


def test_registry_refuses(spark, tmp_path):
    with pytest.raises(SchemaContractError, match="ambiguous"):
        registry_csv.read(spark, csv(tmp_path, HEADER + ",mark_identification", []))
    with pytest.raises(SchemaContractError, match="mark_id_characters.*serial_no"):
        registry_csv.read(spark, csv(tmp_path, HEADER.replace("mark_id_char,", ""), []))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(SchemaContractError, match="header"):
        registry_csv.read(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(Exception, match="FAILFAST"):
        registry_csv.read(spark, csv(tmp_path, lines=["78000001,CORVANE"])).collect()
    with pytest.raises(AcquisitionError):
        registry_csv.acquire(tmp_path)


def test_line_breaks_in_quotes(spark, tmp_path):
    """Both readers agree: refused where files are split, read where they aren't."""
    path = csv(tmp_path, lines=['78000001,"COR\nVANE",4,20110402,700,L', "78000002,LUMERIS,5,20190115,700,?"])
    with pytest.raises(Exception, match="FAILFAST"):
        registry_csv.read(spark, path).collect()
    assert {r.text for r in registry_csv.read_quarantining(spark, path)[0].collect()} == {"LUMERIS"}
    assert {r.text for r in registry_csv.read(spark, path, line_breaks=True).collect()} == {"COR\nVANE", "LUMERIS"} == {r.text for r in registry_csv.read_quarantining(spark, path, line_breaks=True)[0].collect()}


def test_registry_quarantine(spark, tmp_path):
    good, bad = registry_csv.read_quarantining(spark, csv(tmp_path, lines=[*LINES, "78000001,TWICE,4,20110402,700,L", "78000009,SHORT"]))
    assert {r.text for r in good.collect()} == {"LUMERIS", "ZEPRIX"}
    assert sorted(r.reason for r in bad.collect()) == ["duplicate_serial", "duplicate_serial", "malformed"]


def test_landing(spark, tmp_path):
    records = registry_csv.read(spark, csv(tmp_path))
    registry_csv.land(records, str(tmp_path / "landed"), "2030", "sha256:x")
    back = spark.read.parquet(str(tmp_path / "landed"))
    assert back.count() == 3 and {r.vintage for r in back.select("vintage").distinct().collect()} == {2030}
    assert registry_csv.validation(records).first()["standard_share"] == 1.0


def test_fixture_and_data_source(spark, tmp_path):
    provider = fixture.FixtureProvider(names=[("A b", "live"), ("", "")])
    snap = provider.acquire(tmp_path)
    assert provider.extract(spark, snap).count() == 1
    (tmp_path / "bad.tsv").write_text("a\tb\tc\n")
    with pytest.raises(PySparkException, match="one tab"):
        fixture.read_tsv(spark, str(tmp_path / "bad.tsv"), "p").collect()
    spark.dataSource.register(fixture.NamesDataSource)
    (tmp_path / "names").mkdir()
    (tmp_path / "names" / "a.txt").write_text("Corvane\tlive\n\nLumeris\n")
    found = spark.read.format("lexloom_names").option("path", str(tmp_path / "names")).load()
    assert [(t, s) for t, s in rows(found.select("text", "status"))] == [("Corvane", "live"), ("Lumeris", "unknown")]


def test_zone_and_xml(spark, tmp_path):
    (tmp_path / "zone").write_text("; comment\ncorvane.com. 3600 in ns a.\nwww.corvane.com. in a b\nlumeris.com in ns c\nother.org. in ns d\n")
    assert rows(fixture.read_zone(spark, str(tmp_path / "zone"), "com")) == [("corvane",), ("lumeris",)]
    (tmp_path / "d.xml").write_text("<r><case-file><serial-number>1</serial-number><case-file-header><mark-identification>CORVANE</mark-identification><status-code>700</status-code><filing-date>20300101</filing-date></case-file-header></case-file></r>")
    assert rows(fixture.read_daily_xml(spark, str(tmp_path / "d.xml"))) == [("1", "CORVANE", "700", "20300101")]


def test_recorded_times_are_utc(tmp_path):
    row = ledger.SnapshotLedger(tmp_path / "l.json").record(snapshot(tmp_path / "f", 1), dt.datetime(2030, 1, 1, tzinfo=dt.UTC))
    assert row["recorded_at"] == "2030-01-01T00:00:00+00:00" and json.loads((tmp_path / "l.json").read_text())[0] == row
