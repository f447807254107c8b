"""A small curated source in a tab-separated file, and the provider contract as a Spark data source."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from lexloom.operators.ledger import compute_content_hash
from lexloom.types import CORPUS_RECORD, LicenceClass, ProviderDescriptor, ProviderKind, Snapshot

# The fixture's names.
DEFAULT_NAMES = (
    ("Corvane", "live"), ("Lumeris", "live"), ("Zeprix", "dead"), ("Ondara", "live"), ("SOFT DRINKS", "live"), ("3M", "live"), ("XY", "live"), ("INC", "dead"),
)
YEAR = 2020


class FixtureProvider:
    """Writes (name, status) lines and reads them back as corpus records. A provider has a constant descriptor, acquire and extract."""

    def __init__(self, provider_id: str = "fake.curated", licence: LicenceClass = LicenceClass.OPEN_ATTRIBUTION, kind: ProviderKind = ProviderKind.CURATED,
                 names: Sequence[tuple[str, str]] = DEFAULT_NAMES) -> None:
        self.descriptor = ProviderDescriptor(id=provider_id, name=provider_id, kind=kind, licence=licence)
        self.names = tuple(names)

    def acquire(self, destination: Path) -> Snapshot:
        path = destination / f"{self.descriptor.id}.tsv"
        path.write_text("".join(f"{name}\t{status}\n" for name, status in self.names), encoding="utf-8")
        return Snapshot(self.descriptor.id, compute_content_hash(path), path, path.stat().st_size, "fixture")

    def extract(self, spark: SparkSession, snapshot: Snapshot) -> DataFrame:
        return read_tsv(spark, str(snapshot.location), self.descriptor.id)


def read_tsv(spark: SparkSession, path: str, provider_id: str) -> DataFrame:
    """Blank lines are skipped; any other line must have exactly one tab, or the read fails."""
    lines = spark.read.text(path).where(F.trim(F.regexp_replace("value", "\t", "")) != "")
    parts = F.split("value", "\t")
    checked = F.when(F.size(parts) == 2, parts).otherwise(F.raise_error(F.concat(F.lit("a line must hold one tab: "), F.col("value"))))
    return lines.select(checked.alias("p")).select(
        F.col("p")[0].alias("text"), F.lit(provider_id).alias("provider_id"), F.lower(F.col("p")[0]).alias("source_ref"), F.col("p")[1].alias("status"),
        F.lit(YEAR).alias("first_seen_year"), F.array().cast("array<string>").alias("categories"), F.create_map().cast("map<string,string>").alias("source_fields"),
    )


class NamesDataSource(DataSource):
    """``spark.read.format("lexloom_names").option("path", folder)``: files of names, one a line with an optional status after a tab.

    A template for user-defined providers: one partition per file, rows produced lazily where the file is read.
    """

    @classmethod
    def name(cls) -> str:
        return "lexloom_names"

    def schema(self) -> StructType:
        return CORPUS_RECORD

    def reader(self, schema: StructType) -> DataSourceReader:
        return NamesReader(self.options)


class NamesReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.provider_id = options["path"], options.get("provider_id", "local.names")

    def partitions(self) -> list[InputPartition]:
        root = Path(self.path)
        files = sorted(p for p in root.rglob("*") if p.is_file() and not p.name.startswith((".", "_"))) if root.is_dir() else [root]
        return [InputPartition(str(f)) for f in files]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.value, encoding="utf-8") as lines:
            for line in lines:
                name, _, status = line.rstrip("\n").partition("\t")
                if name.strip():
                    yield (name, self.provider_id, name.casefold(), status or "unknown", None, [], {})


def read_zone(spark: SparkSession, path: str, tld: str) -> DataFrame:
    """Distinct registered names (column name) of a zone file: first labels of owner names below ``tld``; comments are skipped."""
    owner = F.lower(F.element_at(F.split("value", r"\s+"), 1))
    label = F.regexp_extract(owner, rf"^(?:.*\.)?([^.]+)\.{tld}\.?$", 1)
    return spark.read.text(path).where(~F.col("value").startswith(";")).select(label.alias("name")).where(F.col("name") != "").distinct()


def read_daily_xml(spark: SparkSession, path: str, row_tag: str = "case-file") -> DataFrame:
    """The daily XML product as flat text columns (serial, text, status_code, filing_date)."""
    schema = "`serial-number` string, `case-file-header` struct<`mark-identification`: string, `status-code`: string, `filing-date`: string>"
    header = F.col("case-file-header")
    return spark.read.schema(schema).xml(path, rowTag=row_tag).select(
        F.col("serial-number").alias("serial"), header["mark-identification"].alias("text"), header["status-code"].alias("status_code"), header["filing-date"].alias("filing_date")
    )
