"""Artifacts: the names of a blend for one use, gated, cleaned, identified by content; and the guards that check them again."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.errors import ArtifactSchemaError
from lexloom.operators import holdout as held
from lexloom.operators import licensing
from lexloom.operators.ordering import joined_in_order
from lexloom.types import CorpusBlend, ProviderDescriptor, Use

ARTIFACT_SCHEMA = 1
SAMPLES = 5


def id_of(use: str, blend_id: str, names: Iterable[str]) -> str:
    """Content address of sorted names, or of stretches of them that are joined already; they are streamed through the hash, never held together."""
    digest = hashlib.sha256(f"{use}|{blend_id}|".encode())
    for i, name in enumerate(names):
        digest.update((f"|{name}" if i else name).encode())
    return f"sha256:{digest.hexdigest()[:32]}"


def id_column(use: Column, blend_id: Column, names: Column) -> Column:
    """The same for an array of names in a row, sorted and distinct first."""
    text = F.concat_ws("|", use, blend_id, F.array_join(F.array_sort(F.array_distinct(names)), "|"))
    return F.concat(F.lit("sha256:"), F.substring(F.sha2(text, 256), 1, 32))


@dataclass
class CorpusArtifact:
    """``names`` is a frame (normalized), sorted where it is written; the rest is the manifest."""

    use: Use
    blend_id: str
    provider_ids: tuple[str, ...]
    names: DataFrame
    excluded_by_holdout: dict[str, int]

    @property
    def artifact_id(self) -> str:
        return id_of(str(self.use), self.blend_id, (text for _, text in joined_in_order(self.names, "normalized", "|")))

    def write(self, path: str) -> str:
        """Names as sorted Parquet files and the manifest as one line of JSON, below ``path``; returns the id."""
        spark = self.names.sparkSession
        self.names.orderBy("normalized").write.mode("overwrite").parquet(f"{path}/names")
        stored = CorpusArtifact(self.use, self.blend_id, self.provider_ids, spark.read.parquet(f"{path}/names"), self.excluded_by_holdout)
        manifest = {
            "schema": ARTIFACT_SCHEMA, "artifact_id": stored.artifact_id, "use": str(self.use), "blend_id": self.blend_id,
            "provider_ids": list(self.provider_ids), "excluded_by_holdout": self.excluded_by_holdout, "count": stored.names.count(),
        }
        spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
        return manifest["artifact_id"]

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> CorpusArtifact:
        manifest = json.loads(spark.read.text(f"{path}/manifest").first()[0])
        if manifest.get("schema") != ARTIFACT_SCHEMA:
            raise ArtifactSchemaError(f"{path}: unknown artifact schema {manifest.get('schema')!r}")
        return cls(Use(manifest["use"]), manifest["blend_id"], tuple(manifest["provider_ids"]), spark.read.parquet(f"{path}/names"), manifest.get("excluded_by_holdout", {}))


def build(use: Use, blend: CorpusBlend, descriptors: Iterable[ProviderDescriptor], evidence: DataFrame, holdout: DataFrame | None = None) -> CorpusArtifact:
    """The artifact of a blend for a use from evidence (normalized, provider_id, ...).

    Gates are checked on the driver before any job: licence then autophagy, provider by provider in the given order. A provider
    the blend doesn't name for this use isn't part of it. Held-out names are taken out of the blended set, for induction only.
    """
    named = blend.providers(use)
    in_order = [d for d in descriptors if d.id in named]
    licensing.gate(in_order, use)
    ids = [d.id for d in in_order]
    merged = evidence.where(F.col("provider_id").isin(ids) if ids else F.lit(False)).select("normalized").distinct()
    excluded: dict[str, int] = {}
    if holdout is not None and use == Use.INDUCTION:
        found = held.contamination(merged, holdout)
        excluded = {r["key"]: r["n_names"] for r in held.excluded_histogram(found).collect()}
        merged = found.where(F.col("key").isNull()).select("normalized")
    return CorpusArtifact(use, blend.blend_id, tuple(sorted(ids)), merged, excluded)


def read_json(spark: SparkSession, pattern: str) -> DataFrame:
    """Artifacts stored as JSON documents: (path, artifact_id, use_kind, blend_id, provider_ids, names); another schema number is refused."""
    schema = "schema int, artifact_id string, use string, blend_id string, provider_ids array<string>, names array<string>, excluded_by_holdout map<string,bigint>"
    df = spark.read.schema(schema).json(pattern, multiLine=True).withColumn("path", F.input_file_name())
    wrong = df.where((F.col("schema") != ARTIFACT_SCHEMA) | F.col("schema").isNull()).select("path", "schema").limit(1).collect()
    if wrong:
        raise ArtifactSchemaError(f"{wrong[0]['path']}: unknown artifact schema {wrong[0]['schema']!r}")
    return df.withColumnRenamed("use", "use_kind").drop("schema")


def contaminated(artifacts: DataFrame, holdout: DataFrame) -> DataFrame:
    """(artifact_id, normalized, key) for the held-out names in induction artifacts."""
    names = artifacts.where(F.col("use_kind") == "induction").select("artifact_id", F.explode("names").alias("name")).where("name is not null").select(
        "artifact_id", F.lower("name").alias("normalized")
    ).distinct()
    found = held.contamination(names, holdout).where(F.col("key").isNotNull())
    return names.join(found, "normalized").select("artifact_id", "normalized", "key")


def near_contaminated(artifacts: DataFrame, holdout: DataFrame) -> DataFrame:
    """``contaminated`` by the exact name and deletion keys only."""
    names = artifacts.where(F.col("use_kind") == "induction").select("artifact_id", F.explode("names").alias("name")).where("name is not null").select(
        "artifact_id", F.lower("name").alias("normalized")
    ).distinct()
    return names.join(held.near_contamination(names, holdout), "normalized").select("artifact_id", "normalized", "key")


def contamination_samples(found: DataFrame) -> DataFrame:
    """(artifact_id, n_hits, samples): per artifact the number of names found and its first five.

    The window is limited to its first five before it shuffles; the count is combined map-side. No task holds an artifact's hits.
    """
    counts = found.groupBy("artifact_id").agg(F.count("*").alias("n_hits"))
    first = found.withColumn("_rank", F.row_number().over(Window.partitionBy("artifact_id").orderBy("normalized"))).where(F.col("_rank") <= SAMPLES)
    samples = first.groupBy("artifact_id").agg(F.array_join(F.array_sort(F.collect_list("normalized")), ",").alias("samples"))
    return counts.join(samples, "artifact_id")


def check(artifacts: DataFrame, providers: DataFrame, holdout: DataFrame | None) -> DataFrame:
    """All violations of all artifacts as (artifact_id, violation, detail): licences, autophagy, contamination, missing holdout."""
    gates = licensing.artifact_violations(artifacts, providers).select("artifact_id", "violation", F.col("provider_id").alias("detail"))
    induction = artifacts.where(F.col("use_kind") == "induction")
    if holdout is None:
        leaks = induction.select("artifact_id", F.lit("no_holdout").alias("violation"), F.lit("").alias("detail"))
    else:
        leaks = contamination_samples(contaminated(artifacts, holdout)).select("artifact_id", F.lit("contaminated").alias("violation"), F.concat_ws(": ", F.col("n_hits").cast("string"), "samples").alias("detail"))
    return gates.unionByName(leaks)


def write_json(artifact: dict, path: Path) -> None:
    path.write_text(json.dumps({"schema": ARTIFACT_SCHEMA, **artifact}, indent=2) + "\n", encoding="utf-8")
