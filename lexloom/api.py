"""The corpus build in four calls: a provider's snapshot in, an artifact out. All data stays in DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession

from lexloom.operators import artifact, normalise as rules
from lexloom.operators.aggregate import saturation as aggregate
from lexloom.operators.holdout import HoldoutIndex, HoldoutSeal, load_holdout, seal, verify_seal
from lexloom.operators.ledger import SnapshotLedger
from lexloom.operators.licensing import induction_eligible, permits, permitted_uses, require
from lexloom.operators.normalise import normalise
from lexloom.types import CorpusBlend, ProviderDescriptor, Snapshot, Use

__all__ = [
    "CorpusProvider", "HoldoutIndex", "HoldoutSeal", "ProviderResult", "aggregate", "build_artifact", "induction_eligible", "ingest", "load_holdout", "normalise", "permits",
    "permitted_uses", "require", "seal", "verify_seal",
]


@runtime_checkable
class CorpusProvider(Protocol):
    """A source: what it is, how a snapshot is fetched, and how its records are read (lazily, as a frame)."""

    descriptor: ProviderDescriptor

    def acquire(self, destination: Path) -> Snapshot: ...

    def extract(self, spark: SparkSession, snapshot: Snapshot) -> DataFrame: ...


@dataclass(frozen=True)
class ProviderResult:
    descriptor: ProviderDescriptor
    report: DataFrame
    names: DataFrame


def ingest(spark: SparkSession, provider: CorpusProvider, snapshot: Snapshot, dictionary: DataFrame | None = None, profanity: DataFrame | None = None, ledger: SnapshotLedger | None = None) -> ProviderResult:
    """A provider's funnel and evidence, both still lazy. With a ledger the snapshot is verified and accepted first."""
    if ledger is not None:
        ledger.accept(snapshot)
    records = provider.extract(spark, snapshot)
    return ProviderResult(provider.descriptor, rules.funnel(records), aggregate(normalise(records, dictionary, profanity)))


def build_artifact(use: Use, blend: CorpusBlend, results: Sequence[ProviderResult], holdout: DataFrame | None = None) -> artifact.CorpusArtifact:
    """The gated, blended and cleaned names for a use from several providers' results."""
    evidence = results[0].names
    for result in results[1:]:
        evidence = evidence.unionByName(result.names)
    return artifact.build(use, blend, [r.descriptor for r in results], evidence, holdout)
