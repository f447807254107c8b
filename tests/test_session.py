"""The shared folder, what is written to it, and what may be broadcast."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lexloom import session


def _fake(master, checkpoint=None):
    kept = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: checkpoint), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None))
    return kept


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host", "local-cluster[3,2,1024]"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_fake(master))
    assert session.shared_dir(_fake(master, "file:///shared/")) == "file:///shared"


def test_one_process_may_use_a_folder_of_its_own():
    assert "lexloom-" in session.shared_dir(_fake("local[4]"))


def test_only_own_places_are_cleared(spark, tmp_path):
    class Elsewhere:
        """The session, with a shared folder of its own."""

        sparkContext = spark.sparkContext
        conf = SimpleNamespace(get=lambda key, default=None: str(tmp_path))

    mine, other = tmp_path / f"lexloom-{spark.sparkContext.applicationId}-x-1", tmp_path / "lexloom-app-999-x-1"
    mine.mkdir(), other.mkdir()
    session.clear_scratch(Elsewhere())
    assert not mine.exists() and other.exists()


def test_broadcast_only_within_bounds_and_computed_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(session, "materialise", lambda df, label, was=session.materialise: written.append(label) or was(df, label))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    counted = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert hinted(session.broadcast_if_small(counted)) and written == ["side"]
    assert not hinted(session.broadcast_if_small(counted, 3)) and hinted(session.broadcast_if_small(spark.range(5))) and len(written) == 2
    monkeypatch.setattr(session, "BROADCAST_BYTES", 10)
    assert not hinted(session.broadcast_if_small(counted))


def test_a_block_leaves_nothing_behind(spark):
    import os

    place = session.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(place))
    with session.scratch(spark):
        assert session.materialise(spark.range(3), "inside").count() == 3 and set(os.listdir(place)) > before
    assert set(os.listdir(place)) == before
