"""Snapshots: integrity, the truncation guard and the append-only ledger."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.errors import SnapshotValidationError
from lexloom.types import Snapshot

#: How much smaller than the one before a snapshot may be (a fixed value).
SHRINK_TOLERANCE = 0.10
CHUNK = 1 << 20


def compute_content_hash(path: Path) -> str:
    digest = hashlib.sha256()
    with path.open("rb") as f:
        while chunk := f.read(CHUNK):
            digest.update(chunk)
    return f"sha256:{digest.hexdigest()}"


def verify_integrity(snapshot: Snapshot) -> None:
    """It exists, has the recorded size, has the recorded hash - in this order."""
    if not snapshot.location.exists():
        raise SnapshotValidationError(f"{snapshot.location} doesn't exist")
    size = snapshot.location.stat().st_size
    if size != snapshot.byte_size:
        raise SnapshotValidationError(f"{snapshot.location} has {size} bytes instead of {snapshot.byte_size}")
    if compute_content_hash(snapshot.location) != snapshot.content_hash:
        raise SnapshotValidationError(f"{snapshot.location} isn't the file that was recorded: its hash differs")


def validate_against_previous(snapshot: Snapshot, previous_size: int | None, tolerance: float = SHRINK_TOLERANCE) -> None:
    """Refuse a snapshot smaller than the one before by more than the tolerance; exactly at the limit is accepted."""
    if previous_size and snapshot.byte_size < previous_size * (1 - tolerance):
        lost = 1 - snapshot.byte_size / previous_size
        raise SnapshotValidationError(f"{snapshot.provider_id} {snapshot.vintage} shrank by {lost:.0%}, from {previous_size} to {snapshot.byte_size} bytes")


class SnapshotLedger:
    """A JSON list of accepted snapshots, appended to. A missing file, or one that isn't a list, is an empty ledger."""

    def __init__(self, path: Path) -> None:
        self.path = path

    def rows(self) -> list[dict]:
        found = json.loads(self.path.read_text(encoding="utf-8")) if self.path.exists() else []
        return found if isinstance(found, list) else []

    def latest(self, provider_id: str) -> dict | None:
        """The provider's row appended last, whatever its time stamp."""
        return next((r for r in reversed(self.rows()) if r["provider_id"] == provider_id), None)

    def record(self, snapshot: Snapshot, now: dt.datetime | None = None) -> dict:
        row = {
            "provider_id": snapshot.provider_id, "content_hash": snapshot.content_hash, "byte_size": snapshot.byte_size,
            "vintage": snapshot.vintage, "recorded_at": (now or dt.datetime.now(dt.UTC)).isoformat(),
        }
        self.path.parent.mkdir(parents=True, exist_ok=True)
        self.path.write_text(json.dumps([*self.rows(), row], indent=2) + "\n", encoding="utf-8")
        return row

    def accept(self, snapshot: Snapshot, tolerance: float = SHRINK_TOLERANCE) -> dict:
        """Verify, compare, record; a snapshot that is refused isn't recorded."""
        verify_integrity(snapshot)
        before = self.latest(snapshot.provider_id)
        validate_against_previous(snapshot, before["byte_size"] if before else None, tolerance)
        return self.record(snapshot)


def latest(ledger: DataFrame) -> DataFrame:
    """The row appended last per provider."""
    row = F.struct("ledger_seq", *[c for c in ledger.columns if c not in ("ledger_seq", "provider_id")])
    return ledger.groupBy("provider_id").agg(F.max(row).alias("_r")).select("provider_id", "_r.*")


def steps(ledger: DataFrame) -> DataFrame:
    """Every ledger row with the size of the provider's snapshot before it and what share was lost (negative: it grew)."""
    before = F.lag("byte_size").over(Window.partitionBy("provider_id").orderBy("ledger_seq"))
    return ledger.withColumn("previous_size", before).withColumn("lost_share", F.lit(1.0) - F.try_divide("byte_size", "previous_size"))


def truncations(ledger: DataFrame, tolerance: float = SHRINK_TOLERANCE) -> DataFrame:
    """Ledger rows the truncation guard would refuse."""
    return steps(ledger).where(F.col("byte_size") < F.col("previous_size") * (1 - F.lit(tolerance)))


def replayed(ledger: DataFrame, tolerance: float = SHRINK_TOLERANCE) -> DataFrame:
    """(ledger_seq, provider_id, byte_size, accepted) as if each delivery were checked against the last accepted one of its provider, in order.

    A refused delivery isn't recorded, so it doesn't become the measure of the next. A ledger has a row per delivery, so what
    is gone through in order is as long as a provider has deliveries.
    """
    row = F.struct("ledger_seq", "byte_size")
    begin = F.struct(F.lit(None).cast("bigint").alias("last"), F.array().cast("array<struct<ledger_seq:bigint,byte_size:bigint,accepted:boolean>>").alias("seen"))

    def step(state: Column, r: Column) -> Column:
        ok = ~F.coalesce((state["last"] > 0) & (r["byte_size"] < state["last"] * (1 - F.lit(tolerance))), F.lit(False))
        return F.struct(F.when(ok, r["byte_size"]).otherwise(state["last"]).alias("last"), F.concat(state["seen"], F.array(F.struct(r["ledger_seq"].alias("ledger_seq"), r["byte_size"].alias("byte_size"), ok.alias("accepted")))).alias("seen"))

    by_provider = ledger.groupBy("provider_id").agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    return by_provider.select("provider_id", F.explode(F.aggregate("_rows", begin, step, lambda s: s["seen"])).alias("r")).select("r.ledger_seq", "provider_id", "r.byte_size", "r.accepted")


def freshness(ledger: DataFrame, as_of: str) -> DataFrame:
    """(provider_id, last_recorded, age_days) at a given time; clocks of providers differ, so the last by time is taken."""
    at = F.to_timestamp(F.regexp_replace(F.regexp_replace("recorded_at", r"Z$", "+00:00"), " ", "T"))
    newest = ledger.groupBy("provider_id").agg(F.max(at).alias("last_recorded"))
    return newest.withColumn("age_days", F.datediff(F.to_date(F.lit(as_of)), "last_recorded"))


def observed_shrink(records: DataFrame, ledger: DataFrame, tolerance: float = SHRINK_TOLERANCE) -> DataFrame:
    """(provider_id, vintage, n_rows, previous_rows, refused) from the rows that really arrived for the accepted snapshots."""
    arrived = records.groupBy("provider_id", "vintage").agg(F.count("*").alias("n_rows"))
    accepted = ledger.groupBy("provider_id", "vintage").agg(F.min("ledger_seq").alias("ledger_seq"))
    before = F.lag("n_rows").over(Window.partitionBy("provider_id").orderBy("ledger_seq"))
    known = accepted.join(arrived, ["provider_id", "vintage"], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0))).withColumn("previous_rows", before)
    return known.select("provider_id", "vintage", "n_rows", "previous_rows", F.coalesce(F.col("n_rows") < F.col("previous_rows") * (1 - F.lit(tolerance)), F.lit(False)).alias("refused"))
