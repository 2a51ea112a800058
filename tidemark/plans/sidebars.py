"""The sidebar run: folders' tables of contents, kept over runs, with a memory of folders that have none."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import first_segment, toc_target
from ..functions.scalars import days_between, is_iso_date, json_signature
from ..operators import quality, queues
from ..operators.dedupe import first_per
from ..sources.shared import settled
from .runs import toc_directories

GROUPS = "array<struct<title: array<string>, landing: string, pages: array<string>>>"
TOCS = f"toc string, since string, sig string, pages int, groups {GROUPS}"
NONE = "folder string, day string"


@dataclass(frozen=True)
class SidebarLimits:
    """Fixed values of the run: pages of a folder that is asked, folders asked for the first time, days after which a folder without a sidebar is asked again, and the gates."""

    least_pages: int = 3
    probes: int = 6000
    recheck_days: int = 28
    most_failed: float = 10
    least_sample: int = 20
    breaker: int = 50
    chunk: int = 100
    most_malformed: float = 10
    least_kept: float = 70
    least_before: int = 200


@dataclass
class SidebarRun:
    """Sidebars and the memory of folders without one, as the run leaves them."""

    tocs: DataFrame
    none: DataFrame
    plan: DataFrame
    asked: int
    failed: int
    waiting: int
    #: Whether neither table differs from the run before, so that nothing need be written.
    unchanged: bool


def plan(index: DataFrame, tocs: DataFrame, none: DataFrame, today: str, limits: SidebarLimits = SidebarLimits(), families: list[str] | None = None) -> DataFrame:
    """folder, action for every folder that holds pages or was known.

    refresh: it had a sidebar, and is asked in every run; probe: it is asked for
    the first time or again, those never asked first, then the oldest answers;
    wait: as probe, beyond the budget; answered: it had none not long ago; small:
    too few pages; dropped: it was known and holds no page any more.
    """
    inside = index.where(first_segment("path").isin(*families)) if families else index
    rows = toc_directories(inside).join(tocs.select(F.col("toc").alias("folder"), F.lit(True).alias("has")).distinct(), "folder", "full")
    rows = rows.join(none.groupBy("folder").agg(F.max("day").alias("day"), F.lit(True).alias("had_none")), "folder", "full")
    recent = is_iso_date("day") & (days_between("day", F.lit(today)) < limits.recheck_days)
    action = F.when(F.col("n").isNull(), "dropped").when(F.col("has"), "refresh").when(F.col("n") < limits.least_pages, "small").when(recent, "answered").otherwise("ask")
    rows = settled(rows.select("folder", "day", F.coalesce("had_none", F.lit(False)).alias("had_none"), action.alias("action")))
    chosen = queues.top(rows.where("action = 'ask'"), [F.col("had_none").asc(), F.coalesce("day", F.lit("")), F.col("folder")], limits.probes).select("folder", F.lit("probe").alias("now"))
    return rows.join(chosen, "folder", "left").select("folder", F.coalesce("now", F.when(F.col("action") == "ask", "wait").otherwise(F.col("action"))).alias("action"))


def _walk(items: list, trail: list[str], out: list) -> list:
    """Groups (title, landing, hrefs of the entries directly in it) in the order of the sidebar."""
    own = [trail, None, []]
    out.append(own)
    below = []
    for item in items:
        if not isinstance(item, dict):
            continue
        href = item.get("href") if isinstance(item.get("href"), str) else None
        if isinstance(item.get("children"), list) and item["children"]:
            below.append((item, href))
        elif href:
            own[2].append(href)
    for item, href in below:
        title = item.get("toc_title")
        _walk(item["children"], [*trail, " ".join(title.split()) if isinstance(title, str) else ""], out)[1] = href
    return own


def parsed(answers: DataFrame, host: str | None = None) -> DataFrame:
    """folder, outcome, groups of answers (folder, outcome, toc): outcome ok, none, malformed (JSON without a list of items) or failed.

    A sidebar is a tree, of which Spark has no type: the walk runs in Python, a
    sidebar at a time; hrefs are resolved by column functions.  Pages of a group
    stand once each; groups without page and landing are left out.
    """

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            rows = []
            for folder, outcome, text in zip(frame["folder"], frame["outcome"], frame["toc"]):
                if outcome != "ok":
                    rows.append((folder, "none" if outcome == "notFound" else "failed", None))
                    continue
                try:
                    top = json.loads(text or "")
                except ValueError:  # a page where JSON should be
                    rows.append((folder, "failed", None))
                    continue
                if isinstance(top, dict) and isinstance(top.get("items"), list):
                    out: list = []
                    _walk(top["items"], [], out)
                    rows.append((folder, "ok", [{"title": t, "landing": g, "pages": p} for t, g, p in out]))
                else:
                    rows.append((folder, "malformed", None))
            yield pd.DataFrame(rows, columns=["folder", "outcome", "raw"])

    raw = answers.select("folder", "outcome", "toc").mapInPandas(run, f"folder string, outcome string, raw {GROUPS}")
    page = lambda h: toc_target(h, "folder", host)
    groups = F.transform("raw", lambda g: F.struct(g.title.alias("title"), page(g.landing).alias("landing"), F.array_distinct(F.filter(F.transform(g.pages, page), lambda p: p.isNotNull())).alias("pages")))
    return raw.select("folder", "outcome", F.filter(groups, lambda g: (F.size(g.pages) > 0) | g.landing.isNotNull()).alias("groups"))


def _pages(groups) -> F.Column:
    each = F.flatten(F.transform(groups, lambda g: F.concat(F.filter(F.array(g.landing), lambda p: p.isNotNull()), g.pages)))
    return F.array_distinct(each)


def merged(tocs: DataFrame, none: DataFrame, planned: DataFrame, answers: DataFrame, today: str) -> tuple[DataFrame, DataFrame]:
    """(tocs, none) after answers (folder, outcome, groups): an answer replaces what a folder had, all others keep it.

    A sidebar whose signature has not changed keeps its record and its day; a
    folder that answers that it has none loses its sidebar; dropped folders go.
    """
    dropped = planned.where("action = 'dropped'").select("folder")
    new = answers.where("outcome = 'ok'").select(F.col("folder").alias("toc"), F.lit(today).alias("since"), json_signature("groups").alias("sig"), F.size(_pages("groups")).alias("pages"), "groups")
    empty = answers.where("outcome = 'none'").select("folder")
    old = tocs.join(dropped.union(empty).select(F.col("folder").alias("toc")), "toc", "left_anti")
    names = [f.split()[0] for f in ("since", "sig", "pages", "groups")]
    both = old.select("toc", *[F.col(c).alias(f"o_{c}") for c in names]).join(new, "toc", "full")
    stays = F.col("sig").isNull() | F.col("sig").eqNullSafe(F.col("o_sig"))
    after = both.select("toc", *[F.when(stays, F.col(f"o_{c}")).otherwise(F.col(c)).alias(c) for c in names])
    kept = none.join(dropped, "folder", "left_anti").join(empty, "folder", "left_anti").join(after.select(F.col("toc").alias("folder")), "folder", "left_anti")
    return after, kept.groupBy("folder").agg(F.max("day").alias("day")).unionByName(empty.distinct().select("folder", F.lit(today).alias("day")))


def totals(tocs: DataFrame) -> DataFrame:
    """One row: tocs, groups, pages (of each sidebar), unique_pages (of all)."""
    rows = tocs.select(F.size("groups").alias("g"), "pages", F.posexplode_outer(_pages("groups")).alias("i", "page"))
    first = F.coalesce(F.col("i"), F.lit(0)) == 0
    own = lambda c: F.coalesce(F.sum(F.when(first, F.col(c))), F.lit(0))
    return rows.agg(F.count_if(first).alias("tocs"), own("g").alias("groups"), own("pages").alias("pages"), F.count_distinct("page").alias("unique_pages"))


def sidebar_run(
    index: DataFrame, tocs: DataFrame, none: DataFrame, ask: Callable[[DataFrame], DataFrame], today: str,
    limits: SidebarLimits = SidebarLimits(), families: list[str] | None = None, same_scope: bool = True, host: str | None = None,
) -> SidebarRun:
    """A run over the folders of an index (path), from the tables of the run before (TOCS, NONE).

    ask takes (folder, queue_pos), in order of folders, and gives (folder,
    outcome ok / notFound / else, toc as JSON text); folders it leaves out are
    not asked, and keep what they had.  After each `chunk` of answers the run
    stops asking if more than half have failed.  With another scope than before,
    nothing of the former run is used.  Raises GateFailure, with nothing to be
    written, if too many requests fail, too many answers are no sidebars, or far
    fewer pages stand in a sidebar than before.
    """
    spark = index.sparkSession
    if not same_scope:
        tocs, none = spark.createDataFrame([], TOCS), spark.createDataFrame([], NONE)
    before_tocs, before_none = first_per(tocs, ["toc"], [F.asc("since"), F.asc("sig")]), none
    planned = settled(plan(index, tocs, none, today, limits, families))
    todo = queues.numbered(planned.where("action in ('refresh', 'probe')").select("folder"), "folder")
    told = settled(parsed(ask(todo), host).join(todo, "folder"))
    told, broke = queues.before_half_failed(told, "queue_pos", F.col("outcome").isin("failed", "malformed"), limits.breaker, limits.chunk)
    n = {r[0]: r[1] for r in told.groupBy("outcome").count().collect()}
    asked, failed, malformed = sum(n.values()), n.get("failed", 0), n.get("malformed", 0)
    after, no_toc = (settled(t) for t in merged(before_tocs, before_none, planned, told, today))
    was, now = (totals(t).first().unique_pages for t in (before_tocs, after))
    gates = [
        quality.ratio_gate(spark, "failed requests", failed, asked, limits.most_failed, limits.least_sample),
        quality.ratio_gate(spark, "answers without a table of contents", malformed, malformed + n.get("ok", 0), limits.most_malformed, limits.least_sample),
    ]
    if was >= limits.least_before:
        gates.append(quality.kept_gate(spark, "pages in a sidebar group", was, now, limits.least_kept))
    if broke:
        gates.append(quality.gate(spark, "breaker", asked, limits.breaker, False, f"stopped after {asked} requests: more than half failed"))
    quality.enforce(*gates)
    sign = lambda t, key: t.select(F.xxhash64(key, *[c for c in t.columns if c not in (key, "groups")]).alias("h")).agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
    unchanged = same_scope and sign(after, "toc") == sign(before_tocs.select(after.columns), "toc") and sign(no_toc, "folder") == sign(before_none.groupBy("folder").agg(F.max("day").alias("day")), "folder")
    return SidebarRun(after, no_toc, planned, asked, failed + malformed, planned.where("action = 'wait'").count(), unchanged)
