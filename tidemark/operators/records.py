"""Records in normal form, snapshots of any version, and what is left out of comparisons."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import col, entry_path
from ..functions.scalars import is_timestamp, text_or_null
from .queues import numbered

#: Columns of a catalogue record, in their order (fixed values of the format); others follow by name.
RECORD = ("title", "url", "product", "subproduct", "description", "lastmod", "checked")
#: What a record carries only while it is in quarantine, or in the catalogue.
HELD = ("status", "firstDetected", "lastChecked", "lastmod", "checked")


def is_object(df: DataFrame, column: str) -> bool:
    """Whether a column holds objects: by its type, for all rows at once."""
    return column in df.columns and isinstance(df.schema[column].dataType, (T.StructType, T.MapType))


def normal_record(rows: DataFrame) -> DataFrame:
    """Known columns in their order, a missing title empty, a missing check null; unknown columns stay, after them, by name."""
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    known = [F.coalesce(have("title"), F.lit("")).alias("title"), *[have(c).alias(c) for c in RECORD[1:-1]], F.nullif(have("checked"), F.lit("")).alias("checked")]
    return rows.select(*known, *sorted(c for c in rows.columns if c not in RECORD))


def strip_quarantine(rows: DataFrame) -> DataFrame:
    return rows.drop(*HELD)


def strip_checked(rows: DataFrame) -> DataFrame:
    return rows.drop("checked")


def module_path_of(path: Column | str, url: Column | str, host: str | None = None) -> Column:
    """A record's path: as it stands, or from its URL."""
    return F.coalesce(entry_path(path, host), entry_path(url, host))


SNAPSHOT = "lastChecked string, modules array<struct<uid:string, title:string, path:string, url:string, unitUrls:array<string>, units:array<string>, hierarchyNotFound:boolean>>, outOfScope array<string>"


def compact_snapshots(texts: DataFrame, text: str = "content", time: str = "time", host: str | None = None) -> DataFrame:
    """Modules of catalogue snapshots of any version: texts' other columns, lastChecked, uid, title, path, unitUrls, units, hierarchyNotFound, out_of_scope.

    A text that is no catalogue (no list of modules) gives no rows.  lastChecked
    is the snapshot's, else the stamp in `time`.  Fields a version lacks are null.
    """
    rest = [c for c in texts.columns if c != text]
    parsed = texts.select(*rest, F.from_json(text, SNAPSHOT).alias("_s")).where("_s.modules is not null")
    stamp = F.when(is_timestamp("_s.lastChecked"), F.col("_s.lastChecked"))
    if time in texts.columns:
        stamp = F.coalesce(stamp, F.when(is_timestamp(F.col(time).cast("string")), F.col(time).cast("string")))
    scope = F.filter(F.transform("_s.outOfScope", lambda p: entry_path(p, host)), lambda p: p.isNotNull())
    one = parsed.select(*rest, stamp.alias("lastChecked"), scope.alias("out_of_scope"), F.explode("_s.modules").alias("_m"))
    one = one.withColumn("path", module_path_of("_m.path", "_m.url", host)).where("path is not null")
    units = F.when(F.col("_m.unitUrls").isNotNull(), F.coalesce("_m.units", F.array().cast("array<string>")))
    return one.select(*rest, "lastChecked", F.col("_m.uid").alias("uid"), text_or_null("_m.title").alias("title"), "path", F.col("_m.unitUrls").alias("unitUrls"), units.alias("units"), F.when(F.col("_m.hierarchyNotFound"), True).alias("hierarchyNotFound"), "out_of_scope")


def snippet(c: Column | str, limit: int = 2000) -> Column:
    """The head of an error body."""
    return F.substring(col(c), 1, limit)


def stable_signature(rows: DataFrame, volatile: tuple[str, ...] = ("generatedAt", "lastChecked", "checked")) -> str:
    """A signature of a table's content: of its rows as a multiset, columns by name, volatile ones aside."""
    names = sorted(c for c in rows.columns if c not in volatile)
    h = F.xxhash64(*[F.to_json(F.struct(c)) for c in names])
    one = rows.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.pmod(F.xxhash64(h), F.lit(1 << 31))).alias("s")).first()
    return f"{one.n}:{(one.x or 0) & (1 << 64) - 1:x}:{one.s or 0}"


def envelope(rows: DataFrame, key: str, generated_at: str, **fields) -> DataFrame:
    """The lines (value) of a file, in order: a head (generatedAt, the given fields by name, count), an entry a line by key, an end.

    Together they are one JSON object; no task holds more than its own lines.
    sources.files.write_text makes a file of them.
    """
    names = [key, *sorted(c for c in rows.columns if c != key)]
    entries = numbered(rows.select(F.col(key).cast("string").alias("_key"), F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("_json")), "_key", "_json")
    head = {"generatedAt": generated_at, **dict(sorted(fields.items())), "count": rows.count()}
    first = json.dumps(head, ensure_ascii=False)[:-1] + ', "entries": ['
    ends = rows.sparkSession.createDataFrame([(0, 0, first), (2, 0, "]}")], "part int, queue_pos long, value string")
    lines = entries.select(F.lit(1).alias("part"), "queue_pos", F.concat(F.when(F.col("queue_pos") == 1, "").otherwise(","), "_json").alias("value"))
    return ends.unionByName(lines).orderBy("part", "queue_pos").select("value")
