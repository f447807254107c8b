"""Facts as a stream: exactly-once append to the history, windowed counts with late data, and the best fact kept as state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_history(facts: DataFrame, path: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Append each new fact once, dropping what was delivered again within ``delay``; partitioned by day of check."""
    once = facts.withWatermark("checked_at", delay).dropDuplicatesWithinWatermark(["candidate_id", "source", "checked_at"])
    return (
        once.withColumn("checked_date", F.to_date("checked_at")).writeStream.partitionBy("checked_date").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def windowed_counts(facts: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """(window_start, source, n_facts, mean_confidence) of each closed window; works on a stream and on a table."""
    grouped = facts.withWatermark("checked_at", delay).groupBy(F.window("checked_at", window), "source")
    return grouped.agg(F.count("*").alias("n_facts"), F.avg("confidence").alias("mean_confidence")).select(F.col("window.start").alias("window_start"), "source", "n_facts", "mean_confidence")


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """(user_id, session_start, session_end, n_events) with sessions closed by a gap."""
    grouped = events.withWatermark("ts", delay).groupBy("user_id", F.session_window("ts", gap))
    return grouped.agg(F.count("*").alias("n_events")).select("user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n_events")


FACT_COLUMNS = ["candidate_id", "confidence", "checked_at", "source", "status"]


def _best(facts: DataFrame) -> DataFrame:
    best = facts.groupBy("candidate_id").agg(F.max(F.struct(*FACT_COLUMNS[1:])).alias("f"))
    return best.select("candidate_id", "f.*")


def upsert_best(facts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The best fact per candidate as the engine's own keyed state; each micro-batch writes the candidates whose best fact changed.

    A batch costs what it changes, not what the state holds. Run again after a failure it writes the same folder anew, so a lost
    executor or driver repeats nothing. ``best_so_far`` reads the changes, ``compact`` makes one of many.
    """

    def changed(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={epoch:09d}")

    return _best(facts).writeStream.outputMode("update").foreachBatch(changed).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def best_so_far(spark: SparkSession, path: str) -> DataFrame:
    """The best fact per candidate from all changes written; a change written twice makes no difference."""
    return _best(spark.read.option("recursiveFileLookup", "true").parquet(path).select(*FACT_COLUMNS))


def compact(spark: SparkSession, path: str, to: str) -> None:
    """The changes below ``path`` as one table below ``to``; what is read there is the same."""
    best_so_far(spark, path).write.mode("overwrite").parquet(f"{to}/base")
