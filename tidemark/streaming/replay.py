"""Structured Streaming extensions: weekly runs replayed as micro-batches.

The batch semantics are those of the operators; nothing here adds to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ledger import ENTRY, apply_changes


def windowed_counts(events: DataFrame, time: str, by: str, length: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Counts by window and key; works on streams (append mode) and tables."""
    rows = events.withColumn(time, F.col(time).cast("timestamp"))
    return rows.withWatermark(time, late).groupBy(F.window(time, length), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def deduplicated(events: DataFrame, time: str, keys: list[str], late: str = "2 hours") -> DataFrame:
    """Events once per key within the watermark's reach."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def sessions(events: DataFrame, time: str, by: str, gap: str = "30 minutes") -> DataFrame:
    rows = events.withColumn(time, F.col(time).cast("timestamp"))
    return rows.groupBy(F.session_window(time, gap), by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), by, "n")


def replay(spark: SparkSession, results: DataFrame, table: str, checkpoint: str, family: str, day: str) -> StreamingQuery:
    """Apply a stream of probe results (path, kind, outcome, to, status) to a Parquet ledger, batch by batch.

    Each batch reads <table>/v<n> and writes <table>/v<n+1>, so a batch that is
    run again after a failure gives the same ledger.
    """
    from ..sources.files import exists

    def step(batch: DataFrame, n: int) -> None:
        old = spark.read.parquet(f"{table}/v{n}") if exists(spark, f"{table}/v{n}") else spark.createDataFrame([], ENTRY)
        found = batch.where("outcome <> 'live'").select("path", "kind", F.lit(None).cast("string").alias("parent"), F.lit(None).cast("string").alias("title"), F.lit("live-probe").alias("evidence"), F.lit(day).alias("firstSeen")).dropDuplicates(["path"])
        live = batch.where("outcome = 'live'").select("path")
        apply_changes(old, found, batch.select("path", "outcome", "to", "status"), live, family, day).write.mode("overwrite").parquet(f"{table}/v{n + 1}")

    return results.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
