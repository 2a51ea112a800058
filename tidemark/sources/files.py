"""Reading and writing of data files: JSON documents, TSV indexes, Markdown trees.

All reads and writes go through Spark, so any store that Spark reaches will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SCHEMA_VERSION, LedgerError
from ..functions.paths import canonical_path
from ..functions.scalars import lastmod_or_null
from ..operators.ledger import ENTRY, normal_ledger
from .shared import settled


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = False) -> DataFrame | None:
    """A JSON document as one row; a missing file is None, a damaged one too unless strict."""
    if not exists(spark, path):
        return None
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)
    if strict:
        return df
    try:
        df.limit(1).collect()
    except Exception as e:
        if isinstance(e, AnalysisException):
            raise
        return None
    return df


def records(document: DataFrame, field: str) -> DataFrame:
    """The rows of an array field, with their place."""
    return document.select(F.posexplode(field).alias("ord", "r")).select("ord", "r.*")


def read_ledger(spark: SparkSession, folder: str, host: str | None = None) -> DataFrame:
    """Both change files of a folder as one ledger.

    The header must have the known version; single bad rows are left out; a
    missing file is an empty one.
    """
    entry = T.StructType([f for f in T._parse_datatype_string(ENTRY).fields if f.name != "file"])
    schema = T.StructType([T.StructField("schemaVersion", T.IntegerType()), T.StructField("generatedAt", T.StringType()), T.StructField("entries", T.ArrayType(entry))])
    parts = []
    for name in ("removed", "moved"):
        doc = read_json(spark, f"{folder}/{name}.json", schema, strict=True)
        if doc is None:
            continue
        try:
            version = doc.select("schemaVersion").first()
        except Exception as e:
            raise LedgerError(f"{name}.json cannot be read") from e
        if version is None or version[0] != SCHEMA_VERSION:
            raise LedgerError(f"{name}.json has version {version and version[0]}, not {SCHEMA_VERSION}")
        parts.append(records(doc, "entries").drop("ord").withColumn("file", F.lit(name)))
    empty = spark.createDataFrame([], ENTRY)
    for p in parts:
        empty = empty.unionByName(p)
    return normal_ledger(empty, host)


def write_ledger(ledger: DataFrame, folder: str, generated_at: str) -> None:
    """Both change files of a ledger with one entry per path: an entry a line, by path, each file put in place in one step.

    Entries are sorted as rows and written as they come: no task holds a file's content.
    """
    ledger = settled(ledger)
    for name in ("removed", "moved"):
        rows = ledger.where(F.col("file") == name).drop("file")
        entry = F.to_json(F.struct("path", *[c for c in rows.columns if c != "path"]), {"ignoreNullFields": "false"})
        first = rows.agg(F.min("path")).first()[0]
        head = f'{{"schemaVersion": {SCHEMA_VERSION}, "generatedAt": {json.dumps(generated_at)}, "entries": ['
        frame = rows.sparkSession.createDataFrame([(0, "", head), (2, "", "]}")], "ord int, path string, value string")
        lines = rows.select(F.lit(1).alias("ord"), "path", F.concat(F.when(F.col("path") == first, "").otherwise(","), entry).alias("value"))
        write_text(frame.unionByName(lines).orderBy("ord", "path").select("value"), f"{folder}/{name}.json")


def write_document(row: DataFrame, path: str) -> None:
    """One row as one JSON file: written beside its place, then renamed."""
    write_text(row.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")), path)


def put_in_place(spark: SparkSession, made: str, path: str) -> None:
    """Rename a file over another in one step: readers, and a run that is killed, find the old file or the new one."""
    fs, new = _fs(spark, made)
    _, goal = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    if fs.getUri().getScheme() == "file":  # a rename of the operating system replaces; the old file's checksum goes first
        raw = fs.getRawFileSystem()
        raw.delete(jvm.org.apache.hadoop.fs.Path(goal.getParent(), f".{goal.getName()}.crc"), False)
        if not raw.rename(new, goal):
            raise OSError(f"{made} cannot be renamed to {path}")
        return
    options = spark.sparkContext._gateway.new_array(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = next(x for x in jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename").getEnumConstants() if str(x) == "OVERWRITE")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(new, goal, options)


def write_text(lines: DataFrame, path: str) -> None:
    """One column of lines, in the order of the table, as one file.

    Tasks write a part each; parts are joined in the order of the partitions,
    which is that of a sorted table, by a stream that holds a buffer's bytes; the
    whole is then put in place in one step.  A run that fails or is killed leaves
    the old file, and a folder <path>.<id>.tmp at most.
    """
    spark = lines.sparkSession
    folder = f"{path}.{uuid.uuid4().hex}.tmp"
    jvm = spark.sparkContext._jvm
    fs, tmp = _fs(spark, folder)
    try:
        lines.write.option("compression", "none").text(folder)
        whole = jvm.org.apache.hadoop.fs.Path(tmp, "whole")
        out = fs.create(whole, True)
        try:
            for part in sorted(s.getPath().getName() for s in fs.listStatus(tmp)):
                if not part.startswith("part-"):
                    continue
                held = fs.open(jvm.org.apache.hadoop.fs.Path(tmp, part))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(held, out, 1 << 20, False)
                finally:
                    held.close()
        finally:
            out.close()
        put_in_place(spark, whole.toString(), path)
    finally:
        fs.delete(tmp, True)


def put_table(spark: SparkSession, staged: str, path: str) -> None:
    """Put a folder in the place of another: the old one stays beside it as <path>.before until the new one is there."""
    restored(spark, path)
    fs, new = _fs(spark, staged)
    _, goal = _fs(spark, path)
    _, old = _fs(spark, f"{path}.before")
    if fs.exists(goal) and not fs.rename(goal, old):
        raise OSError(f"{path} cannot be set aside")
    if not fs.rename(new, goal):
        raise OSError(f"{staged} cannot be renamed to {path}")
    fs.delete(old, True)


def restored(spark: SparkSession, path: str) -> None:
    """After a run that was killed between both renames of put_table: the old folder takes its place again, or goes if the new one is there."""
    fs, goal = _fs(spark, path)
    _, old = _fs(spark, f"{path}.before")
    if fs.exists(old):
        if fs.exists(goal):
            fs.delete(old, True)
        else:
            fs.rename(old, goal)


def write_if_changed(df: DataFrame, path: str) -> bool:
    """Write a Parquet table unless the one there has the same rows (by count and hash); whether it was written."""
    spark = df.sparkSession
    mark = lambda d: d.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*sorted(d.columns))).alias("x"), F.sum(F.pmod(F.xxhash64(F.lit(1), *sorted(d.columns)), F.lit(1 << 31))).alias("s")).first()
    restored(spark, path)
    if exists(spark, path):
        old = spark.read.parquet(path)
        if sorted(old.columns) == sorted(df.columns) and mark(old) == mark(df):
            return False
    staged = f"{path}.{uuid.uuid4().hex}.tmp"
    df.write.parquet(staged)
    put_table(spark, staged, path)
    return True


def read_index(spark: SparkSession, path: str, host: str | None = None) -> DataFrame:
    """path, lastmod of a TSV index ('-': none).  A path that is not canonical, or stands twice, is an error."""
    rows = spark.read.schema("path string, lastmod string").option("sep", "\t").option("quote", "").csv(path)
    rows = rows.where("path is not null").select("path", lastmod_or_null(F.nullif("lastmod", F.lit("-"))).alias("lastmod"))
    bad = rows.where(~F.coalesce(canonical_path("path", host) == F.col("path"), F.lit(False))).select("path").limit(1).collect()
    twice = rows.groupBy("path").count().where("count > 1").limit(1).collect()
    if bad or twice:
        raise ValueError(f"index: bad line for {(bad or twice)[0].path}")
    return rows


def write_index(index: DataFrame, path: str) -> None:
    """The index as a TSV file, by path."""
    bad = index.where(F.col("path").rlike(r"[\x00-\x1f]") | F.coalesce(F.col("lastmod"), F.lit("")).rlike(r"[\x00-\x1f]")).limit(1).collect()
    if bad:
        raise ValueError(f"index: control character in {bad[0].path!r}")
    write_text(index.orderBy("path").select(F.concat_ws("\t", "path", F.coalesce("lastmod", F.lit("-"))).alias("value")), path)


def read_markdown(spark: SparkSession, root: str, skip: Sequence[str] = ("includes", "media", "_themes", "breadcrumb", "archive", "zone-pivots", "obj", "v-fake")) -> DataFrame:
    """path (below root), content of all .md files outside the skipped folders."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(root, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content"))
    base = F.lit(root.rstrip("/").split("://")[-1] + "/")
    rel = F.expr("substring(file, locate(_b, file) + length(_b))")
    rows = rows.withColumn("_b", base).withColumn("path", rel).drop("_b", "file")
    folders = F.slice(F.split("path", "/"), 1, F.greatest(F.size(F.split("path", "/")) - 1, F.lit(0)))
    return rows.where(~F.exists(folders, lambda d: d.isin(*skip))).select("path", "content")


def git_records(files: DataFrame, root: str, base: str, domain: str, description: str = "description") -> DataFrame:
    """url, title, description of Markdown files with a title, noindex pages left out."""
    from ..functions.paths import source_file_url
    from ..functions.text import frontmatter, without_templates

    m = files.withColumn("m", frontmatter("content"))
    item = lambda n: F.try_element_at(F.col("m"), F.lit(n))
    rows = m.where(item("title").isNotNull() & ~F.coalesce(item("robots"), F.lit("")).rlike("(?i)noindex"))
    return rows.select(source_file_url("path", root, base, domain).alias("url"), without_templates(item("title")).alias("title"), without_templates(item(description)).alias("description"))


def carried(fresh: DataFrame, previous: DataFrame, failed: DataFrame, source: str = "source") -> DataFrame:
    """Rows of all sources: fresh ones, and the previous rows of sources that failed."""
    return fresh.unionByName(previous.join(failed.select(source).distinct(), source, "left_semi").select(fresh.columns))
