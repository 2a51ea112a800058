"""Ranked work lists with quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import fnv32
from ..sources.shared import settled


def order_queue(items: DataFrame) -> DataFrame:
    """Freshest lastmod first, none last, then path."""
    return items.orderBy(F.desc_nulls_last("lastmod"), F.asc("path"))


def order_by_checked(items: DataFrame) -> DataFrame:
    """Never checked first, then the oldest check, then URL."""
    return items.orderBy(F.asc_nulls_first("checked"), F.asc("url"))


def split_budget(cap: int, changed: int, fresh: int, min_share: float = 0.2) -> tuple[int, int]:
    """How many changed and new pages fit: changed first, but neither kind below its share while both wait."""
    if cap <= 0:
        return 0, 0
    if changed + fresh <= cap:
        return changed, fresh
    reserve = min(fresh, -int(-(cap * min_share) // 1)) if changed and fresh else 0
    first = min(changed, cap - reserve)
    return first, min(fresh, cap - first)


def top(items: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows: a top-k per task, then of those."""
    return items.orderBy(*order).limit(max(0, k))


def take_budget(items: DataFrame, cap: int, order: list[Column], kind: str = "kind", min_share: float = 0.2) -> DataFrame:
    """Rows of kind 'changed' and 'new' within the fetch cap, each in its order."""
    n = {r[0]: r[1] for r in items.groupBy(kind).count().collect()}
    first, second = split_budget(cap, n.get("changed", 0), n.get("new", 0), min_share)
    return top(items.where(F.col(kind) == "changed"), order, first).unionByName(top(items.where(F.col(kind) == "new"), order, second))


def missing_batch(candidates: DataFrame, cap: int, today: str) -> DataFrame:
    """Which candidates fallen out of the sitemaps to probe.

    Records go by their oldest check; bare paths rotate by a hash of path and
    day; while both wait, each has half the cap, and what one leaves the other takes.
    """
    n = {r[0]: r[1] for r in candidates.groupBy("has_record").count().collect()}
    with_record, bare = n.get(True, 0), n.get(False, 0)
    if cap <= 0:
        return candidates.limit(0)
    paths = min(bare, max(cap - with_record, -(-cap // 2)))
    records = min(with_record, cap - paths)
    paths = max(paths, min(bare, cap - records))
    a = top(candidates.where("has_record"), [F.asc_nulls_first("checked"), F.asc("url")], records)
    b = top(candidates.where("not has_record"), [fnv32(F.concat("path", F.lit(f"|{today}"))), F.asc("path")], paths)
    return a.unionByName(b)


#: Up to this many rows the first of a table are gathered in one task; more are numbered by ranges.
GATHERED = 100_000


def tiered(items: DataFrame, tier: str, order: list[Column], cap: int, tier_caps: dict[int, int] | None = None) -> DataFrame:
    """tier 1 before 2 before 3, each in its order, some tiers capped, all of it capped: rows with queue_pos from 1."""
    parts = []
    for t, most in sorted((tier_caps or {}).items()):
        parts.append(first_rows(items.where(F.col(tier) == t), order, most))
    rest = items.where(~F.col(tier).isin(*(tier_caps or {}))) if tier_caps else items
    for p in parts:
        rest = rest.unionByName(p)
    if cap > GATHERED:
        return numbered(rest, tier, *order).where(F.col("queue_pos") <= cap)
    kept = top(rest, [F.col(tier), *order], cap)
    return kept.withColumn("queue_pos", F.row_number().over(Window.orderBy(tier, *order)).cast("long"))


def first_rows(items: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows, whatever k is: see GATHERED."""
    return top(items, order, k) if k <= GATHERED else numbered(items, *order).where(F.col("queue_pos") <= k).drop("queue_pos")


def verification_queue(changes: DataFrame, today: str | None = None, limit: int = 300, reverify: int = 100, dead: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """The queue of plan_verification."""
    return _verification(changes, today, limit, reverify, dead, exclude)[0]


def plan_verification(changes: DataFrame, today: str | None = None, limit: int = 300, reverify: int = 100, dead: DataFrame | None = None, exclude: DataFrame | None = None) -> tuple[DataFrame, int]:
    """(queue, wanted): path, kind, reason, queue_pos, and how many rows there would be without the limit.

    Unverified entries come first, then moves whose destination changed again,
    then, `reverify` of them, those whose last verification is longest ago.
    Units of a module that is itself unverified wait.  dead: paths known to be no
    longer live.  exclude: paths that are left out before anything is ranked; an
    excluded module that is unverified holds its units back all the same.
    """
    queue, rows = _verification(changes, today, limit, reverify, dead, exclude)
    n = {r[0]: r[1] for r in rows.groupBy("tier").count().collect()}
    return queue, n.get(1, 0) + n.get(2, 0) + min(n.get(3, 0), max(0, reverify))


def _verification(changes, today, limit, reverify, dead, exclude) -> tuple[DataFrame, DataFrame]:
    from .joins import lookup_changes, paths_below

    learn = changes.where("family = 'learn'")
    pending = learn.where("kind = 'module' and outcome = 'unverified'").select("path")
    old = F.lit(today).isNull() | ~F.col("lastVerified").eqNullSafe(today)
    mine = learn.where(F.col("outcome").isin("unverified", "moved") | (old & F.lit(reverify > 0)))  # no other row can have a place
    mine = mine.join(paths_below(mine.where("kind = 'unit'"), pending), "path", "left_anti")
    if exclude is not None:
        mine = mine.join(exclude.select("path").distinct(), "path", "left_anti")
    mine = settled(mine)  # read for its moves, its order and its size
    moved = mine.where("outcome = 'moved' and to is not null")
    again = moved.select("to").limit(0) if moved.isEmpty() else lookup_changes(moved, changes, "to").select(F.col("link").alias("to"))
    again = again.unionByName(dead.select(F.col("path").alias("to"))).distinct() if dead is not None else again
    mine = mine.join(again.withColumn("_again", F.lit(True)), "to", "left")
    tier = F.when(F.col("outcome") == "unverified", 1).when((F.col("outcome") == "moved") & F.col("_again"), 2).when(old, 3)
    mine = mine.withColumn("tier", tier).where("tier is not null")
    mine = mine.withColumn("_o", F.when(F.col("tier") == 1, F.col("firstSeen")).when(F.col("tier") == 3, F.coalesce("lastVerified", F.lit(""))).otherwise(""))
    out = tiered(mine, "tier", [F.asc("_o"), F.asc("path")], limit, {3: reverify})
    return out.select("path", "kind", F.element_at(F.array(*map(F.lit, ("unverified", "collapse", "reverify"))), F.col("tier")).alias("reason"), "queue_pos"), mine


#: Places of a queue that are scanned as one block.
BLOCK = 4096


def trip(rows: DataFrame, order: str, bad: Column, streak: int = 0, late: Column | None = None) -> tuple[int | None, str | None]:
    """(place, cause) of the last row that is run before a queue stops, or nulls where it runs to its end.

    breaker: `streak` bad rows in a row (0: never), the last of which is run, and
    rows are left; deadline: the first row that is late is not run.  order: whole
    numbers in the order of the attempts; a place without a row breaks no streak.
    A prefix scan by blocks of BLOCK places: each counts its bad rows, and one row
    a block carries the count at the last good row over.
    """
    marked = rows.withColumns({"_bad": F.coalesce(bad, F.lit(False)), "_late": F.coalesce(late, F.lit(False)) if late is not None else F.lit(False), "_block": F.floor(F.col(order) / BLOCK)})
    own = Window.partitionBy("_block").orderBy(order)
    n = F.sum(F.col("_bad").cast("long")).over(own)
    base = F.max(F.when(~F.col("_bad"), n)).over(own.rowsBetween(Window.unboundedPreceding, 0))
    scanned = marked.withColumn("_n", n).withColumn("_base", base)
    ends = scanned.groupBy("_block").agg(F.max("_n").alias("all"), F.max("_base").alias("good"))
    over = Window.orderBy("_block")
    ends = ends.withColumn("before", F.sum("all").over(over) - F.col("all"))
    ends = ends.select("_block", "before", F.coalesce(F.max(F.col("before") + F.col("good")).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("last"))
    # bad rows so far, less those up to the last good row, are the streak
    run = F.when(F.col("_base").isNotNull(), F.col("_n") - F.col("_base")).otherwise(F.col("before") + F.col("_n") - F.col("last"))
    broken = F.col("_bad") & (run >= streak) & F.lit(streak > 0)
    at = scanned.join(ends, "_block").agg(F.min(F.when(broken, F.col(order))).alias("breaker"), F.min(F.when(F.col("_late"), F.col(order))).alias("late"), F.max(order).alias("end")).first()
    if at.breaker is not None and at.breaker < at.end and (at.late is None or at.breaker < at.late):
        return at.breaker, "breaker"
    return (None, None) if at.late is None else (at.late - 1, "deadline")


def before_trip(rows: DataFrame, order: str, bad: Column, streak: int, late: Column | None = None) -> DataFrame:
    """The rows of a queue that are run, see trip."""
    last, cause = trip(rows, order, bad, streak, late)
    return rows if cause is None else rows.where(F.col(order) <= last)


def harvest_plan(modules: DataFrame, previous: DataFrame, cap: int, full: bool = False) -> DataFrame:
    """path, reason, queue_pos: modules to read, new before changed before (on a full run) the rest, oldest harvest first."""
    old = previous.select("path", F.col("unitSig").alias("_sig"), "harvestedAt")
    reason = F.when(F.col("_sig").isNull(), "new").when(F.col("_sig") != F.col("unitSig"), "changed").when(F.lit(full), "refresh")
    rows = modules.join(old, "path", "left").withColumn("reason", reason).where("reason is not null")
    rows = rows.withColumn("tier", F.array_position(F.array(F.lit("new"), F.lit("changed"), F.lit("refresh")), F.col("reason")))
    return tiered(rows, "tier", [F.asc_nulls_first("harvestedAt"), F.asc("path")], cap).select("path", "reason", "queue_pos")


def probe_plan(paths: DataFrame, checked: DataFrame, today: str, recheck_days: int, cap: int) -> DataFrame:
    """path, action: kept while its last check is recent, probed oldest first up to the cap, else it waits."""
    last = checked.groupBy("path").agg(F.max("checked").alias("checked"))
    rows = paths.select("path").distinct().join(last, "path", "left")
    stale = F.col("checked").isNull() | (F.datediff(F.lit(today).cast("date"), F.col("checked").cast("date")) >= recheck_days)
    due = top(rows.where(stale), [F.asc_nulls_first("checked"), F.asc("path")], cap).select("path", F.lit("probe").alias("action"))
    return rows.withColumn("stale", stale).join(due, "path", "left").select("path", F.coalesce("action", F.when(F.col("stale"), "wait").otherwise("keep")).alias("action"))


def sitemap_plan(families: DataFrame, memo: DataFrame, signature: str, today: str, recheck_days: int, most: int, full: bool = False) -> DataFrame:
    """family, reason: which sitemap families to download (relevant, unknown, other scopes, or due for a recheck, oldest first, capped)."""
    rows = families.select("family").distinct().join(memo, "family", "left")
    age = F.datediff(F.lit(today).cast("date"), F.col("checked").cast("date"))
    reason = F.when(F.lit(full), "full").when(F.col("relevant").isNull(), "unknown").when(F.col("scope") != signature, "scope-changed").when(F.col("relevant"), "relevant").when(age >= recheck_days, "recheck")
    rows = rows.withColumn("reason", reason).where("reason is not null")
    return rows.where("reason <> 'recheck'").unionByName(top(rows.where("reason = 'recheck'"), [F.asc("checked"), F.asc("family")], most)).select("family", "reason")


def unscoped_segments(rows: DataFrame, in_scope: Column, limit: int = 60) -> DataFrame:
    """segment, n: first segments of paths in no scope, the most frequent."""
    n = rows.where(~in_scope).groupBy("segment").agg(F.count("*").alias("n"))
    return top(n, [F.desc("n"), F.asc("segment")], limit)


def sample(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """n rows drawn at random: the smallest keyed hashes of whole rows."""
    return top(rows, [F.xxhash64(F.lit(seed), *[F.col(c) for c in rows.columns])], n)


def streaks(events: DataFrame, group: str, order: str, bad: Column) -> DataFrame:
    """group, longest: the longest run of bad rows in order (gaps and islands)."""
    w = Window.partitionBy(group).orderBy(order)
    island = F.row_number().over(w) - F.sum(bad.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = events.withColumn("_i", island).withColumn("_b", bad).where("_b").groupBy(group, "_i").agg(F.count("*").alias("n"))
    return events.select(group).distinct().join(runs.groupBy(group).agg(F.max("n").alias("n")), group, "left").select(group, F.coalesce("n", F.lit(0)).alias("longest"))


def running_share(events: DataFrame, group: str, order: str, bad: Column) -> DataFrame:
    """events with done and failed so far in their group."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumn("done", F.count("*").over(w)).withColumn("failed", F.sum(bad.cast("long")).over(w))


def numbered(rows: DataFrame, *order: Column | str) -> DataFrame:
    """rows with queue_pos from 1 in the order of some columns, without gathering them in one task.

    Rows are sorted by ranges and kept in the shared folder; each range is
    numbered by itself, and one row a range carries the count over.
    """
    held = settled(rows.orderBy(*order)).withColumn("_range", F.spark_partition_id())
    sizes = held.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return held.join(before, "_range").withColumn("queue_pos", (own + F.col("_before")).cast("long")).drop("_range", "_before")


def before_half_failed(rows: DataFrame, order: str, bad: Column, least: int, chunk: int) -> tuple[DataFrame, bool]:
    """(rows, tripped): rows up to the end of the first chunk after which more than half of at least `least` rows are bad.

    order: places from 1.  Chunks are counted each for itself, and summed over one row a chunk.
    """
    each = rows.groupBy(F.floor((F.col(order) - 1) / chunk).alias("c")).agg(F.count("*").alias("n"), F.count_if(F.coalesce(bad, F.lit(False))).alias("b"))
    over = Window.orderBy("c")
    so_far = each.select("c", F.sum("n").over(over).alias("n"), F.sum("b").over(over).alias("b"))
    at = so_far.where((F.col("n") >= least) & (F.col("b") * 2 > F.col("n"))).agg(F.min("c").alias("c")).first().c
    return (rows, False) if at is None else (rows.where(F.col(order) <= (at + 1) * chunk), True)
