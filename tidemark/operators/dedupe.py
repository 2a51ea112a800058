"""One row per key, by total orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], losers: bool = False) -> DataFrame:
    """The first row of every key in the given order (or all the others).

    Spark limits the window to its first row in each task, before the shuffle:
    a hot key is a row a task.  That holds for the first rows, not for the others.
    """
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = df.withColumn("_n", n)
    return ranked.where("_n > 1" if losers else "_n = 1").drop("_n")


def best_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """first_per as an aggregate: partial winners meet before the shuffle, so a hot key is a row per task.

    order must be orderable columns, ascending; use negated numbers for descending ones.
    """
    rest = [c for c in df.columns if c not in keys]
    chosen = F.min_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return df.groupBy(*keys).agg(chosen.alias("_w")).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest]).select(df.columns)


def prefer_entry(entries: DataFrame, key: str = "path") -> DataFrame:
    """Newest lastVerified, then oldest firstSeen, then the row as JSON; firstSeen becomes the key's oldest.

    An aggregate, so a hot key is a row a task.  lastVerified is an ISO day or
    null: its digits, each taken from nine, put the newest first and null last.
    """
    newest = F.coalesce(F.translate("lastVerified", "0123456789", "9876543210"), F.lit("~"))
    text = F.to_json(F.struct(*[F.col(c) for c in entries.columns]))
    rest = [c for c in entries.columns if c != key]
    chosen = F.min_by(F.struct(*rest), F.struct(newest.alias("a"), F.col("firstSeen").alias("b"), text.alias("c")))
    out = entries.groupBy(key).agg(chosen.alias("_w"), F.min("firstSeen").alias("_first"))
    return out.select(*[(F.col("_first") if c == "firstSeen" else F.col(key) if c == key else F.col(f"_w.{c}")).alias(c) for c in entries.columns])


def pick_record(rows: DataFrame, key: str, row_url: str | None = None) -> DataFrame:
    """Of duplicate catalogue records: the listed spelling, a title, the newest lastmod, the newest check, the smallest URL."""
    listed = F.when(F.col("url") == F.col(row_url), 0).otherwise(1) if row_url else F.lit(0)
    return first_per(rows, [key], [listed, F.when(F.col("title").isNotNull(), 0).otherwise(1), F.desc_nulls_last("lastmod"), F.desc_nulls_last("checked"), F.asc("url")])


def newest_per_url(rows: DataFrame, ordinal: str) -> DataFrame:
    return first_per(rows, ["url"], [F.desc_nulls_last("lastmod"), F.asc(ordinal)])


def dedupe_rows(rows: DataFrame, prefer: DataFrame | None = None) -> DataFrame:
    """Per path the newest lastmod, then the spelling the catalogue has, then the smallest URL."""
    if prefer is None:
        return first_per(rows, ["path"], [F.desc_nulls_last("lastmod"), F.asc("url")])
    known = prefer.select("path", F.col("url").alias("_known"))
    out = rows.join(known, "path", "left")
    return first_per(out, ["path"], [F.desc_nulls_last("lastmod"), F.when(F.col("url") == F.col("_known"), 0).otherwise(1), F.asc("url")]).drop("_known")


def strongest_candidate(candidates: DataFrame, priority: Sequence[str]) -> DataFrame:
    """Per path the candidate with the strongest evidence, then kind and title."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("evidence"))
    return first_per(candidates.where(rank > 0), ["path"], [rank, F.asc("kind"), F.asc_nulls_last("title")])


def fold_quarantine(rows: DataFrame, key: str = "path", ordinal: str | None = None) -> DataFrame:
    """Per key the first firstDetected, and all else of the row checked last; of equals the one with the smallest ordinal, or the smallest row."""
    first = [F.col(ordinal)] if ordinal else []
    rest = [c for c in rows.columns if c not in (key, "firstDetected", ordinal)]
    # texts compare ascending, so the latest check is the greatest struct; other columns are turned into a rank of their own
    latest = rows.groupBy(key).agg(F.min("firstDetected").alias("firstDetected"), F.max(F.coalesce("lastChecked", F.lit(""))).alias("_last"))
    held = rows.drop("firstDetected").join(latest, key).where(F.coalesce("lastChecked", F.lit("")) == F.col("_last"))
    chosen = F.min_by(F.struct(*rest), F.struct(*first, *[F.col(c).alias(f"_{i}") for i, c in enumerate(rest)]))
    return held.groupBy(key, "firstDetected").agg(chosen.alias("_w")).select(key, "firstDetected", *[F.col(f"_w.{c}").alias(c) for c in rest])


def last_per_path(*groups: DataFrame) -> DataFrame:
    """The union of tables, the last table's row per path, by path."""
    parts = [g.withColumn("_o", F.lit(-i)) for i, g in enumerate(groups)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return first_per(out, ["path"], [F.asc("_o")]).drop("_o")


def exact_duplicates(df: DataFrame, column: str) -> DataFrame:
    """column, n: values that stand more than once."""
    return df.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def alias_duplicates(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, n: keys with more than one different value."""
    return df.groupBy(key).agg(F.countDistinct(value).alias("n")).where("n > 1")


def path_collisions(rows: DataFrame) -> DataFrame:
    """uid, path, winner: rows that lose their path to the newest lastModified, ties to the smaller uid."""
    w = Window.partitionBy("path").orderBy(F.desc_nulls_last("lastModified"), F.asc("uid"))
    out = rows.withColumn("_n", F.row_number().over(w)).withColumn("winner", F.first("uid").over(w))
    return out.where("_n > 1").select("uid", "path", "winner")


def is_sorted_unique(values: Column) -> Column:
    """An array that rises strictly."""
    return F.forall(F.sequence(F.lit(1), F.greatest(F.size(values) - 1, F.lit(1))), lambda i: (F.size(values) < 2) | (F.get(values, i - 1) < F.get(values, i)))


def same_rows(a: DataFrame, b: DataFrame, ignore: Sequence[str] = ()) -> bool:
    """Whether two tables hold the same rows, as multisets, volatile columns aside."""
    a, b = a.drop(*ignore), b.drop(*ignore).select(a.drop(*ignore).columns)
    return a.exceptAll(b).limit(1).count() == 0 and b.exceptAll(a).limit(1).count() == 0
