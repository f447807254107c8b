"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.text import blank_strip_lower
from lexloom.session import broadcast_if_small


def snapshot_steps(ledger: DataFrame, group: str, vintage: str, order: str) -> DataFrame:
    """Per accepted snapshot its number within its group and whether another follows; a vintage accepted twice counts where it came first.

    Columns: group, vintage, ``step`` (from 1), ``last_step``.
    """
    once = ledger.where(F.col(group).isNotNull() & F.col(vintage).isNotNull()).groupBy(group, vintage).agg(F.min(order).alias("_at"))
    by = Window.partitionBy(group)
    return once.select(
        group, vintage,
        F.row_number().over(by.orderBy("_at", vintage)).alias("step"),
        F.count("*").over(by).alias("last_step"),
    )


def snapshot_changes(
    rows: DataFrame, ledger: DataFrame, *, group: str, key: str, vintage: str, latest_by: str, compare: Sequence[str], ledger_order: str
) -> DataFrame:
    """Records added, removed or changed from each accepted snapshot of a group to the next.

    Every row is tagged with the two comparisons it takes part in (as the new side of its own snapshot, as the old side of
    the following one), and one aggregation by (group, key, step) keeps per side the hash of the compared columns of the
    row with the greatest ``latest_by``. No record is ever joined with another, so a key of any weight is combined map-side.

    Returns (group, key, vintage, change_kind) with the later vintage and ``added``, ``removed`` or ``changed``.

    Defined cases: rows of vintages that aren't in the ledger are ignored; null group or key: ignored; null ``latest_by``
    counts as earliest; ties in ``latest_by`` go to the greatest row hash, whatever the row order; a null in ``compare`` is a
    value of its own; empty inputs give an empty result; other columns are ignored.
    """
    steps = snapshot_steps(ledger.select(group, vintage, ledger_order), group, vintage, ledger_order)
    steps = broadcast_if_small(steps)
    hashed = rows.select(group, vintage, F.col(key).alias("_key"), F.col(latest_by).alias("_latest"), F.xxhash64(*compare).alias("_hash"))
    tagged = (
        hashed.where(F.col("_key").isNotNull())
        .join(steps, [group, vintage])
        .select(
            group, "_key", F.struct("_latest", "_hash").alias("_row"),
            F.explode(F.filter(
                F.array(
                    F.when(F.col("step") > 1, F.struct(F.col("step").alias("step"), F.lit(True).alias("is_new"))),
                    F.when(F.col("step") < F.col("last_step"), F.struct((F.col("step") + 1).alias("step"), F.lit(False).alias("is_new"))),
                ),
                lambda x: x.isNotNull(),
            )).alias("_side"),
        )
    )
    sides = tagged.groupBy(group, "_key", F.col("_side.step").alias("step")).agg(
        F.max(F.when(F.col("_side.is_new"), F.col("_row"))).alias("_new"),
        F.max(F.when(~F.col("_side.is_new"), F.col("_row"))).alias("_old"),
    )
    kind = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old._hash") != F.col("_new._hash"), "changed")
    )
    return (
        sides.select(group, "_key", "step", kind.alias("change_kind"))
        .where(F.col("change_kind").isNotNull())
        .join(steps.select(group, "step", vintage), [group, "step"])
        .select(group, F.col("_key").alias(key), vintage, "change_kind")
    )


def corpus_changes(records: DataFrame, ledger: DataFrame) -> DataFrame:
    """``snapshot_changes`` over corpus records: (provider_id, source_ref, vintage, change_kind) by cleaned source_ref and status."""
    cleaned = records.select(
        "provider_id", "vintage", "loaded_at",
        blank_strip_lower(F.col("source_ref")).alias("source_ref"),
        F.coalesce(blank_strip_lower(F.col("status")), F.lit("unknown")).alias("status"),
    )
    return snapshot_changes(
        cleaned, ledger, group="provider_id", key="source_ref", vintage="vintage", latest_by="loaded_at", compare=["status"], ledger_order="ledger_seq"
    )


def change_counts(changes: DataFrame) -> DataFrame:
    """Changes per provider, vintage and kind."""
    return changes.groupBy("provider_id", "vintage", "change_kind").agg(F.count("*").alias("n_changes"))
