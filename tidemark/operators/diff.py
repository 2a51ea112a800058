"""Snapshot comparison: what a newer catalogue no longer has, or has elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EVIDENCE_PRIORITY, KIND_OF_TYPE
from .dedupe import strongest_candidate

CANDIDATE = ("path", "kind", "parent", "title", "evidence", "firstSeen")


def _candidates(df: DataFrame, kind: Column | str, evidence: str, first_seen: Column, parent: Column | None = None, title: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select("path", (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), (none if parent is None else parent).alias("parent"), (none if title is None else title).alias("title"), F.lit(evidence).alias("evidence"), first_seen.alias("firstSeen"))


def tombstones(previous: DataFrame, carried: DataFrame, current: DataFrame, keys: list[str], today: str, last_seen: str | None = None) -> DataFrame:
    """Removed rows: those carried that have not come back, and previous rows that current lacks.

    Columns: keys, path, title, lastSeen, removedOn.
    """
    old = carried.join(current.select(*keys), keys, "left_anti").select(*keys, "path", "title", "lastSeen", "removedOn")
    new = previous.join(current.select(*keys), keys, "left_anti").join(carried.select(*keys), keys, "left_anti")
    return old.unionByName(new.select(*keys, "path", "title", F.lit(last_seen).cast("string").alias("lastSeen"), F.lit(today).alias("removedOn")))


def new_tombstones(previous: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    return current.join(previous.select(*keys), keys, "left_anti")


def renames(previous: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """keys, path (old), to (new): rows of both snapshots whose path differs."""
    old = previous.select(*keys, F.col("path").alias("path"))
    new = current.select(*keys, F.col("path").alias("to"), *([F.col("title")] if "title" in current.columns else []))
    return old.join(new, keys).where("path <> to")


def collisions(removed: DataFrame, live: DataFrame) -> DataFrame:
    """Tombstones whose path is live."""
    return removed.join(live.select("path").distinct(), "path", "left_semi")


def lists_trusted(old: Column, new: Column) -> Column:
    """Both lists are real, and the new one has at least half as many items: else a loss is not believed."""
    return F.coalesce(old.isNotNull() & new.isNotNull() & (F.size(new) > 0) & (F.size(new) * 2 >= F.size(old)), F.lit(False))


def diff_units(previous: DataFrame, current: DataFrame, today: str) -> DataFrame:
    """Candidates: unit paths that a module of both snapshots (by path) no longer lists."""
    both = previous.select("path", F.col("unitUrls").alias("_old")).join(current.select("path", F.col("unitUrls").alias("_new")), "path").where(lists_trusted(F.col("_old"), F.col("_new")))
    gone = both.select(F.col("path").alias("parent"), F.explode(F.filter("_old", lambda u: ~F.array_contains(F.col("_new"), u))).alias("path")).distinct()
    return _candidates(gone, "unit", "unit-diff", F.lit(today), F.col("parent"))


def diff_modules(previous_removed: DataFrame, current: DataFrame, current_removed: DataFrame, previous: DataFrame, today: str) -> DataFrame:
    """Candidates of a module catalogue: new tombstones, modules no longer served, renames; the strongest evidence per path."""
    none = F.lit(None).cast("string")
    t = _candidates(new_tombstones(previous_removed, current_removed, ["uid"]), "module", "tombstone", F.coalesce("removedOn", F.lit(today)), title=F.col("title"))
    n = _candidates(current.where("hierarchyNotFound"), "module", "hierarchy-not-found", F.lit(today), title=F.col("title"))
    r = _candidates(renames(previous, current.select("uid", "path"), ["uid"]), "module", "rename", F.lit(today), title=none)
    return strongest_candidate(t.unionByName(n).unionByName(r).where("path is not null"), EVIDENCE_PRIORITY)


def diff_content(previous: DataFrame, current: DataFrame, previous_removed: DataFrame, current_removed: DataFrame, today: str) -> DataFrame:
    """Candidates of typed content: new tombstones by (type, uid), renames, and study guides that became definitely none."""
    kind = F.element_at(F.create_map(*[x for k, v in KIND_OF_TYPE.items() for x in (F.lit(k), F.lit(v))]), F.col("type"))
    t = _candidates(new_tombstones(previous_removed, current_removed, ["type", "uid"]), kind, "tombstone", F.coalesce("removedOn", F.lit(today)), title=F.col("title"))
    r = _candidates(renames(previous, current.select("type", "uid", "path"), ["type", "uid"]), kind, "rename", F.lit(today))
    guide = previous.where("studyGuide is not null").select("type", "uid", F.col("studyGuide").alias("path"))
    lost = guide.join(current.where("studyGuide is null and guideKnown").select("type", "uid"), ["type", "uid"])
    g = _candidates(lost, "study-guide", "live-probe", F.lit(today))
    return strongest_candidate(t.unionByName(r).unionByName(g).where("path is not null and kind is not null"), EVIDENCE_PRIORITY)


def carry_forward(current: DataFrame, previous: DataFrame, key: str, value: str, trusted: Column) -> DataFrame:
    """current with a missing value taken from the previous row, where `trusted` (over both, previous as _old) holds."""
    out = current.join(previous.select(key, F.col(value).alias("_old")), key, "left")
    return out.withColumn(value, F.coalesce(value, F.when(trusted, F.col("_old")))).drop("_old")


def changed_rows(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """key, action: added, removed, changed or same, by a hash of all other columns."""
    rest = [c for c in previous.columns if c != key]
    a = previous.select(key, F.xxhash64(*rest).alias("_a"))
    b = current.select(key, F.xxhash64(*rest).alias("_b"))
    action = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") == F.col("_b"), "same").otherwise("changed")
    return a.join(b, key, "full").select(key, action.alias("action"))
