"""Every query of this subpackage against its SQL on the smallest test data; those without SQL must run."""

import pytest

from lexloom.llm.oracles import ORACLES
from lexloom.llm.queries import QUERIES
from tools.compare import compare


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, folder, name):
    said = compare(spark, duck, folder, name, QUERIES, ORACLES)
    assert ": equal" in said or "no SQL" in said, said


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_them_all():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
