"""Session set-up, table access and the few helpers that touch the cluster's shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A relation is broadcast only if it has at most this many rows, and no more bytes than this on disk.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
#: Steps of a plan that cost more than reading rows: what has one of them is written before it is counted.
COSTLY = ("Aggregate", "Join", "Window", "Generate", "MapInPandas", "MapInArrow", "ArrowEvalPython", "Deduplicate", "Repartition")


def session(app: str = "lexloom", **conf: object) -> SparkSession:
    """A session with the settings all plans assume: UTC, ANSI and adaptive execution."""
    builder = SparkSession.builder.appName(app).config(map={
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k.replace("__", "."): str(v) for k, v in conf.items()},
    })
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a test-data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder stands in if driver and executors are one process; on a cluster this is refused,
    as each machine would write to a disk of its own and what is read back would be incomplete.
    """
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        place = spark.sparkContext.getCheckpointDir()
    if not place:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        place = tempfile.mkdtemp(prefix="lexloom-")
        spark.sparkContext.setCheckpointDir(place)
    return place.rstrip("/")


def _own(spark: SparkSession) -> str:
    return f"lexloom-{spark.sparkContext.applicationId}"


#: Places given out within each ``scratch`` block that is open.
_open: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder that bears the application's name."""
    path = f"{shared_dir(spark)}/{_own(spark)}-{label}-{uuid.uuid4().hex}"
    for places in _open:
        places.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written to the shared folder within the block is removed at its end; results must have been stored by then."""
    places: list[str] = []
    _open.append(places)
    try:
        yield
    finally:
        _open.remove(places)
        for place in places:
            _remove(spark, place)


def _remove(spark: SparkSession, pattern: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in system.globStatus(path) or []:
        system.delete(found.getPath(), True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    What is written survives the loss of any executor, and later stages read it instead of computing it again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; counts no further than that."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the size allows; otherwise leave the join to the planner (sort-merge, skew-split).

    What costs more than reading is written first, so it is computed once, not for the count and again for the join; its
    bytes on disk are then known as well.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if any(step in plan.toString() for step in COSTLY):
        df = materialise(df, "side")
        plan = df._jdf.queryExecution().optimizedPlan()
        if int(str(plan.stats().sizeInBytes())) > BROADCAST_BYTES:
            return df
    return F.broadcast(df) if small_enough(df, max_rows) else df


def data_dir(default: str = "/root/testdata/sf0.1") -> str:
    return os.environ.get("BENCH_SF_DIR", default)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application has written to the shared folder; frames read from there can't be used afterwards."""
    _remove(spark, f"{shared_dir(spark)}/{_own(spark)}-*")


def with_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """``df`` with the columns of a one-row aggregate, taken as a scalar subquery: computed once, no join."""
    row = one.select(F.struct(*one.columns).alias("_row")).scalar()
    return df.withColumn("_row", row).select(*df.columns, *[F.col(f"_row.{c}").alias(c) for c in one.columns])


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application; they need not have it installed.

    The archive is made on the driver, from where Spark itself copies it to every executor, also to later ones.
    """
    context = spark.sparkContext
    if getattr(context, "_lexloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="lexloom-package-"), "lexloom-package.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._lexloom_shipped = True
