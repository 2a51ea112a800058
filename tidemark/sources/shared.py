"""Cutting lineage in the folder that driver and executors share, and dealing rows to enough tasks."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only where it is unset, and all runs on this machine, one of this machine."""
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """The rows of df, computed once and kept in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


#: Rows that a task sorts for a join or a window; larger tables are dealt to more tasks.
ROWS_A_TASK = 250_000


def tasks_for(*tables: DataFrame) -> int:
    """How many tasks the largest of some tables needs; the session's number of shuffle partitions where that is enough."""
    least = int(tables[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, *(-(-t.count() // ROWS_A_TASK) for t in tables))


def dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """df dealt by keys to a number of tasks, if that is more than Spark would take anyway: a task's memory stays the same as tables grow."""
    return df.repartition(tasks, *keys) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
