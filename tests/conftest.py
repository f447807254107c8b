"""One small session for all tests; a folder of its own stands for the cluster's shared one."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = os.environ.get("LEXLOOM_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexloom.session import session

    s = session("tests", **{
        "spark__master": "local[4]", "spark__sql__shuffle__partitions": "4", "spark__ui__enabled": "false", "spark__ui__showConsoleProgress": "false",
        "spark__checkpoint__dir": str(tmp_path_factory.mktemp("shared")), "spark__sql__warehouse__dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(SMALL):
        pytest.skip(f"no test data in {SMALL}")
    return SMALL


@pytest.fixture(scope="session")
def duck(folder):
    from tools.compare import views

    return views(folder)


def rows(df):
    """The rows of a frame as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
