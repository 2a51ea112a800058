"""What a series of snapshots tells: when a path was lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def snapshot_index(snapshots: DataFrame, time: str) -> DataFrame:
    """time, idx: snapshots in order, from 1."""
    times = snapshots.select(time).distinct()
    return times.withColumn("idx", F.dense_rank().over(Window.orderBy(time)))


def first_missing(snapshots: DataFrame, key: str, time: str) -> DataFrame:
    """key, time: of keys that the newest snapshot lacks, the first snapshot after their last sighting."""
    index = snapshot_index(snapshots, time)
    last = snapshots.join(index, time).groupBy(key).agg(F.max("idx").alias("_last"))
    return last.join(index.select(F.col(time), (F.col("idx") - 1).alias("_last")), "_last").select(key, time)


def consecutive_losses(snapshots: DataFrame, key: str, time: str) -> DataFrame:
    """key, time: every snapshot that lacks a key its predecessor had."""
    index = snapshot_index(snapshots, time)
    rows = snapshots.select(key, time).distinct().join(index, time)
    prior = rows.select(key, (F.col("idx") + 1).alias("idx"))
    lost = prior.join(rows.select(key, "idx"), [key, "idx"], "left_anti")
    return lost.join(index, "idx").select(key, time)


def last_loss(snapshots: DataFrame, key: str, time: str) -> DataFrame:
    """key, time: the latest loss of keys that are still missing."""
    lost = consecutive_losses(snapshots, key, time).groupBy(key).agg(F.max(time).alias(time))
    newest = snapshots.join(snapshots.agg(F.max(time).alias(time)), time, "left_semi")
    return lost.join(newest.select(key).distinct(), key, "left_anti")
