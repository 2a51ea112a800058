"""Shared folders, written intermediate tables and table reading."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows and bytes of an Arrow batch.
BATCH_ROWS, BATCH_BYTES = "2000", "8m"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Only where the setting is missing (tests on one machine) a folder of this
    machine is made, and set, so that checkpoint() finds it as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = jvm_dir.get() if jvm_dir.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A place for an intermediate table, below a folder of this application, which is removed when its driver ends."""
    folder = f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_forget, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


_FOLDERS: set[str] = set()


def _forget(spark: SparkSession, folder: str) -> None:
    """Remove an ended application's tables; where its session is stopped already, they stay for whoever clears the shared folder."""
    if getattr(spark.sparkContext, "_jsc", None) is not None and not spark.sparkContext._jsc.sc().isStopped():
        remove(folder, spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(df_or_path, spark: SparkSession | None = None) -> None:
    """Delete an intermediate table that nothing reads any more."""
    if isinstance(df_or_path, DataFrame):
        spark = df_or_path.sparkSession
        paths = {f.rsplit("/", 1)[0] for f in df_or_path.inputFiles()}
    else:
        paths = {df_or_path}
    for path in paths:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of BATCH_ROWS and BATCH_BYTES; a session that sets these options itself keeps its own."""
    for name, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(f"spark.sql.execution.arrow.{name}", None) is None:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", value)


def id_text(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] = ()) -> DataFrame:
    """(doc_id, text, and columns to keep) of rows that have an id; a null text becomes an empty one.

    Texts that go to Python go in small batches (small_batches), bounded beside
    that by the longest text.
    """
    small_batches(docs.sparkSession)
    return docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *keep)


def tagged(docs: DataFrame) -> DataFrame:
    """(doc_id, text, tag) as id_text; tag, a 32-bit hash of the text, tells rows of one doc_id with different texts apart."""
    return id_text(docs).withColumn("tag", F.hash("text"))
