"""Every query of the catalogue against its SQL on the smallest test data; those without SQL must run."""

import pytest

from lexloom.plans import files, generation, problems, reference
from tools.compare import compare

MODULES = (problems, reference, files, generation)
QUERIES, ORACLES = {k: q for m in MODULES for k, q in m.QUERIES.items()}, {k: q for m in MODULES for k, q in m.ORACLES.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, folder, name):
    said = compare(spark, duck, folder, name, QUERIES, ORACLES)
    assert ": equal" in said or "no SQL" in said, said


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_without_the_subpackage_for_training_data(spark, folder):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert entry.entry(spark).columns[0] == "provider_id"


def test_nothing_imports_the_subpackage_for_training_data():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "lexloom"
    outside = [p for p in root.rglob("*.py") if "llm" not in p.parts and "lexloom.llm" in p.read_text(encoding="utf-8")]
    assert outside == []
