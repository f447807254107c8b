"""Occurrences and records of every distinct term, kept up to date by signed deltas in a store that outlives its session."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.session import broadcast_if_small, scratch_path

#: Terms per bucket of a run; a run has as many buckets as its size asks for.
BUCKET_ROWS = 5_000_000
#: A run is merged with the one before it once it has at least this share of its rows.
COMPACT_SHARE = 0.5

COUNTS = "scope string, term string, occurrences bigint, records bigint"


def change_deltas(changes: DataFrame, *, scope: str, sign: Column, term: Column, occurrences: Column, distinct: Sequence[str] | None = None) -> DataFrame:
    """Deltas (scope, term, occurrences, records) of a change feed: only rows that came, went or changed.

    ``sign`` is 1 for a record as it is after the change and -1 for one as it was before; a changed record is two rows.
    With ``distinct`` (columns) rows equal in all of these, and of one sign, are one record. One aggregation by term, combined
    map-side; unchanged records are never read.

    Defined cases: null or empty terms are ignored; null occurrences count as 0; the sum may be zero or negative.
    """
    signed = changes.withColumn("_sign", sign).withColumn("_term", term).withColumn("_n", F.coalesce(occurrences, F.lit(0)).cast("bigint"))
    if distinct is not None:
        signed = signed.groupBy(*distinct, "_sign", "_term", "_n").agg(F.lit(1))
    return (
        signed.where((F.col("_term") != "") & F.col("_sign").isNotNull()).groupBy(F.lit(scope).alias("scope"), F.col("_term").alias("term"))
        .agg(F.sum(F.col("_n") * F.col("_sign")).cast("bigint").alias("occurrences"), F.sum("_sign").cast("bigint").alias("records"))
    )


def changed_rows(before: DataFrame, after: DataFrame, record: Sequence[str]) -> DataFrame:
    """The change feed between two full states, where no feed is delivered: the columns ``record`` and ``sign``.

    Rows are told apart by all their columns, and rows repeated in one state are one. Where a source delivers its changes,
    ``change_deltas`` should read those instead.
    """
    sides = before.select(*record, F.lit(-1).alias("_s")).unionByName(after.select(*record, F.lit(1).alias("_s")))
    once = sides.groupBy(*record).agg((F.max(F.when(F.col("_s") > 0, 1).otherwise(0)) - F.max(F.when(F.col("_s") < 0, 1).otherwise(0))).alias("sign"))
    return once.where(F.col("sign") != 0)


class TermCounts:
    """Persistent counts by (scope, term) in a folder on shared storage; open it again with the same path.

    The store is a list of runs, oldest and largest first. ``merge`` writes the deltas as a new run, so it costs what the
    deltas cost; while the last run has at least half as many rows as the one before, the two are summed into one, so there are
    at most log2(rows) runs and each term is written again that often at most. A run's terms lie in buckets by
    their hash, as many as its size asks for, so a lookup reads one bucket of each run.

    A version is a manifest, a file of its own that is written last and names its runs: a merge that fails leaves the former
    version, a session that opens the folder sees the latest whole one. What neither the latest nor the version before
    names is removed. One writer at a time: a second one's manifest of the same number is refused.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, bucket_rows: int = BUCKET_ROWS) -> None:
        self.spark, self.path, self.bucket_rows = spark, path or scratch_path(spark, "termcounts"), bucket_rows
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.version, self.runs = self._latest()

    def _manifests(self) -> dict[int, object]:
        found = self._fs.globStatus(self._Path(f"{self.path}/manifest-*.json")) or []
        return {int(f.getPath().getName().removeprefix("manifest-").removesuffix(".json")): f.getPath() for f in found}

    def _latest(self) -> tuple[int, list[dict]]:
        known = self._manifests()
        if not known:
            return 0, []
        version = max(known)
        return version, self._read(known[version])

    def _read(self, place) -> list[dict]:
        stream = self._fs.open(place)
        text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return json.loads(text)["runs"]

    def _frame(self, runs: Sequence[dict], buckets: Sequence[Sequence[int]] | None = None) -> DataFrame:
        places = []
        for k, r in enumerate(runs):
            places += [f"{self.path}/{r['id']}"] if buckets is None else [f"{self.path}/{r['id']}/bucket={b}" for b in buckets[k]]
        return self.spark.read.schema(COUNTS).option("recursiveFileLookup", "true").parquet(*places) if places else self.spark.createDataFrame([], COUNTS)

    @staticmethod
    def _summed(rows: DataFrame) -> DataFrame:
        summed = rows.groupBy("scope", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
        return summed.where((F.col("records") != 0) | (F.col("occurrences") != 0))

    def counts(self) -> DataFrame:
        """(scope, term, occurrences, records) of the version this object has opened or made; terms without any record left are gone."""
        return self._frame(self.runs) if len(self.runs) < 2 else self._summed(self._frame(self.runs))

    def lookup(self, term: str) -> DataFrame:
        """The counts of one term in all scopes: one bucket of each run is read."""
        at = [[self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(term)), F.lit(r["buckets"]))).first()[0]] for r in self.runs]
        kept = [(r, b) for r, b in zip(self.runs, at, strict=True) if self._fs.exists(self._Path(f"{self.path}/{r['id']}/bucket={b[0]}"))]
        return self._summed(self._frame([r for r, _ in kept], [b for _, b in kept]).where(F.col("term") == term))

    def totals(self) -> DataFrame:
        """(scope, total): all occurrences of a scope. Deltas add up, so no term is merged for it."""
        return self._frame(self.runs).groupBy("scope").agg(F.sum("occurrences").alias("total"))

    def _write(self, rows: DataFrame, at_most: int = 0) -> dict:
        """A run of ``rows``, of at most so many rows; where that isn't known, as with deltas, in one bucket."""
        name, buckets = f"run-{uuid.uuid4().hex}", max(1, -(-at_most // self.bucket_rows))
        if buckets == 1:
            rows.write.parquet(f"{self.path}/{name}/bucket=0")
        else:
            spread = rows.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
            spread.repartition(buckets, "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{name}")
        run = {"id": name, "rows": 0, "buckets": buckets}
        return run | {"rows": self._frame([run]).count()}

    def merge(self, deltas: DataFrame) -> None:
        """Add deltas (scope, term, occurrences, records) and make the next version."""
        known = max(self._manifests(), default=0)
        if known != self.version:
            raise RuntimeError(f"{self.path} is at version {known}, not {self.version}: open it again before merging")
        delta = self._write(deltas.where((F.col("records") != 0) | (F.col("occurrences") != 0)).select("scope", "term", "occurrences", "records"))
        runs = [*self.runs, delta] if delta["rows"] else list(self.runs)
        first = len(runs) - 1
        while first > 0 and sum(r["rows"] for r in runs[first:]) >= COMPACT_SHARE * runs[first - 1]["rows"]:
            first -= 1
        if 0 <= first < len(runs) - 1:
            together = self._write(self._summed(self._frame(runs[first:])), sum(r["rows"] for r in runs[first:]))
            runs = [*runs[:first], *([together] if together["rows"] else [])]
        self._publish(runs)

    def _publish(self, runs: list[dict]) -> None:
        version = self.version + 1
        place, draft = self._Path(f"{self.path}/manifest-{version}.json"), self._Path(f"{self.path}/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.writeBytes(json.dumps({"version": version, "runs": runs}))
        out.close()
        if self._fs.exists(place) or not self._fs.rename(draft, place):
            raise RuntimeError(f"{place.toString()} exists: another writer was faster")
        former = self.runs
        self.version, self.runs = version, runs
        kept = {r["id"] for r in [*former, *runs]}
        for number, manifest in self._manifests().items():
            if number < version - 1:
                self._fs.delete(manifest, False)
        for found in self._fs.globStatus(self._Path(f"{self.path}/run-*")) or []:
            if found.getPath().getName() not in kept:
                self._fs.delete(found.getPath(), True)


def verdicts(counts: DataFrame, totals: DataFrame | None = None, *, rare_at_most: int = 2, common_share: float = 0.02) -> DataFrame:
    """Every term with its counts and whether it is too rare or too common to be useful; null verdict: useful.

    ``rare`` wins over ``common``. The share is of the occurrences of all terms of the same scope (``totals``: scope, total).
    """
    if totals is None:
        totals = counts.groupBy("scope").agg(F.sum("occurrences").alias("total"))
    return counts.join(broadcast_if_small(totals), "scope").select(
        "scope", "term", "occurrences", "records",
        F.when(F.col("occurrences") <= rare_at_most, "rare").when(F.col("occurrences") >= F.lit(Decimal(str(common_share))) * F.col("total"), "common").alias("verdict"),
    )
