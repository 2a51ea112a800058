"""Whole runs: previous tables and fetched facts in, new tables out.

Fetching is not part of a run: what a site answered comes as tables (or, for
rounds of probes, as a function from a queue to results).  Every run checks its
gates before it gives anything back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Limits, Site
from ..functions.paths import in_scope, parent_path
from ..functions.scalars import json_signature
from ..operators import build, classify, dedupe, diff, docs, history, ledger, quality, queues
from ..sources.shared import dealt, settled, tasks_for
from . import validate

Probe = Callable[[DataFrame], DataFrame]


@dataclass
class CatalogueResult:
    modules: DataFrame
    removed: DataFrame
    out_of_scope: DataFrame
    collisions: DataFrame
    refresh: DataFrame
    ledger: DataFrame


def catalogue_run(
    api: DataFrame, units: DataFrame, taxonomy: DataFrame, previous: DataFrame, previous_removed: DataFrame, fetched: DataFrame, changes: DataFrame, probe: Probe,
    allowed: list[str], today: str, limits: Limits = Limits(), least: int = 1, most_drop: float = 20.0, full: bool = False,
) -> CatalogueResult:
    """Modules of a catalogue download.

    api (uid, title, path, products, units, lastModified, firstUnitPath), units
    (uid, lastModified), taxonomy (id, name, children), fetched (uid, outcome,
    urls): hierarchy answers for the modules that the plan asks for.
    """
    spark = api.sparkSession
    tops = build.categories(api, build.flatten_taxonomy(taxonomy), "products")
    inside, outside = build.split_scope(api, tops, allowed)
    lost = dedupe.path_collisions(inside)
    inside = inside.join(lost.select("uid"), "uid", "left_anti").join(build.unit_signature(inside, units), "uid")
    quality.enforce(quality.floor_gate(spark, "modules", inside.count(), least), quality.drop_gate(spark, "modules", previous.count(), inside.count(), most_drop))
    plan = build.plan_refresh(inside, previous, full)
    urls = build.resolve_units(inside, plan, previous, fetched)
    modules = inside.join(urls, "uid").join(tops.select("uid", F.col("tops").alias("categories")), "uid", "left")
    removed = diff.tombstones(previous, previous_removed, api, ["uid"], today)
    candidates = diff.diff_modules(previous_removed, modules, removed, previous, today).unionByName(diff.diff_units(previous, modules, today))
    live = modules.where("not coalesce(hierarchyNotFound, false)").select("path").union(modules.select(F.explode("unitUrls").alias("path"))).union(outside.select("path")).distinct()
    done = ledger.refresh(changes, candidates, live, "learn", today, probe, limits.probes)
    return CatalogueResult(modules, removed, outside.select("path"), lost, plan, done)


def content_run(current: DataFrame, probes: DataFrame, previous: DataFrame, previous_removed: DataFrame, changes: DataFrame, live: DataFrame, probe: Probe, today: str, limits: Limits = Limits(), most_drop: float = 20.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items, removed, ledger) of the typed content lists: current (type, uid, title, path), guide probes (uid, path, outcome)."""
    quality.enforce(quality.content_gates(previous.groupBy("type").agg(F.count("*").alias("n")), current.groupBy("type").agg(F.count("*").alias("n")), most_drop, {}))
    items = build.apply_guide_probes(current, previous.select("uid", "studyGuide"), probes)
    removed = diff.tombstones(previous, previous_removed, current, ["type", "uid"], today)
    candidates = diff.diff_content(previous, items, previous_removed, removed, today)
    return items, removed, ledger.refresh(changes, candidates, live, "learn", today, probe, limits.probes)


@dataclass
class DocsResult:
    plan: DataFrame
    records: DataFrame
    index: DataFrame
    quarantine: DataFrame
    redirects: DataFrame
    ledger: DataFrame
    states: DataFrame
    counts: DataFrame
    #: False where a sitemap file failed: the index is then not to be written.
    index_written: bool


def docs_run(
    rows: DataFrame, catalogue: DataFrame, previous_index: DataFrame, quarantine: DataFrame, redirects: DataFrame, results: DataFrame, changes: DataFrame, today: str,
    site: Site = Site(), limits: Limits = Limits(), sitemap_ok: bool = True,
) -> DocsResult:
    """The documentation index of a sitemap pass.

    rows (url, path, lastmod), catalogue (path, url, title, lastmod, checked and
    more), quarantine (path, url, title, status, firstDetected, lastChecked),
    redirects (from, to, kind, status, firstSeen, lastSeen), results (path,
    outcome, status, to, title, noindex): what the plan's queues found.  Columns
    of the catalogue that the engine does not know stay with their records.
    """
    spark = rows.sparkSession
    inside = rows.where(in_scope("path", site.learn) | in_scope("path", site.index))
    sitemap = dedupe.dedupe_rows(inside, dedupe.first_per(catalogue.select("path", "url"), ["path"], [F.asc("url")]))
    quality.enforce(quality.index_gate(spark, sitemap.count(), quality.index_baseline(previous_index.count(), catalogue.count())), quality.duplicates_gate(sitemap, "url", "path"))
    known = ledger.normal_redirects(redirects)
    plan = settled(docs.plan(sitemap, catalogue, previous_index, quarantine, known, today, site, limits.redirect_recheck_days, sitemap_ok))
    states = settled(docs.reconcile(plan, results, today, site))
    index = states.where("in_index").select("path", F.col("index_lastmod").alias("lastmod"))
    new = states.where("state = 'moved'").select(F.col("path").alias("from"), F.col("moved_to").alias("to"), classify.classify_redirect("path", "moved_to").alias("kind"), F.col("moved_status").alias("status"))
    moved = ledger.update_redirects(known, new, states.where("contradicted").select("path"), index, previous_index.select("path"), today, (site.learn, site.index))
    held = states.where("quarantined").select("path", "url", "title", "status", "firstDetected", "lastChecked")
    entries = ledger.docs_entries(moved, held, today)
    return DocsResult(plan, docs.records(states, catalogue, sitemap, results, site), index, held, moved, ledger.replace_family(changes, "docs", entries), states, docs.run_counts(states), sitemap_ok)


def links_run(links: DataFrame, caches: validate.Caches, probes: DataFrame, today: str, site: Site = Site()) -> DataFrame:
    """Links of modules (module, pos, path) cleaned: decided by the caches, else by probes (path, verdict, redirects_to), else unverified.

    plans.module_links is the whole run.
    """
    tasks = tasks_for(links)
    paths = dealt(links.select("path"), tasks, "path").distinct()
    known = validate.validate(paths, caches, site, url="path").select("path", classify.decide_offline(F.col("path"), F.col("verdict"), F.col("redirects_to"), F.col("confidence")).alias("decision"), F.col("redirects_to").alias("to"))
    live = probes.select("path", classify.decide_probe(F.col("path"), F.col("verdict"), F.col("redirects_to")).alias("p_decision"), F.col("redirects_to").alias("p_to"))
    both = dealt(known, tasks, "path").join(dealt(live, tasks, "path"), "path", "left").select("path", F.coalesce("decision", "p_decision", F.lit("unverified")).alias("decision"), F.when(F.col("decision").isNotNull(), F.col("to")).otherwise(F.col("p_to")).alias("to"))
    return build.apply_decisions(links, both, today)


def toc_run(groups: DataFrame, previous: DataFrame, today: str) -> DataFrame:
    """toc, sig, since, pages, groups: sidebars from flat groups (folder, ord, title, landing, pages); since moves when the signature does."""
    rows = groups.groupBy(F.col("folder").alias("toc")).agg(F.sort_array(F.collect_list(F.struct("ord", "title", "landing", "pages"))).alias("groups"))
    rows = rows.withColumn("sig", json_signature("groups")).withColumn("pages", F.size(F.array_distinct(F.flatten(F.transform("groups", lambda g: g.pages)))))
    old = previous.select("toc", F.col("sig").alias("_sig"), F.col("since").alias("_since"))
    return rows.join(old, "toc", "left").select("toc", "sig", F.when(F.col("_sig") == F.col("sig"), F.col("_since")).otherwise(F.lit(today)).alias("since"), "pages", "groups")


def toc_directories(index: DataFrame, least_pages: int = 1) -> DataFrame:
    """folder, n: folders with enough pages; pages at the root are in none."""
    return index.groupBy(parent_path("path").alias("folder")).agg(F.count("*").alias("n")).where("folder is not null").where(F.col("n") >= least_pages)


def seed_run(snapshots: DataFrame, links: DataFrame, caches: validate.Caches, changes: DataFrame, live: DataFrame, probe: Probe, site: Site = Site(), limits: Limits = Limits(), today: str = "") -> tuple[DataFrame, DataFrame]:
    """(ledger, report) seeded from a catalogue's history (path, day, kind) and from a list of links (url)."""
    return seeded(snapshots, links, caches, changes, live, probe, site, limits, today)[:2]


def seeded(snapshots: DataFrame, links: DataFrame, caches: validate.Caches, changes: DataFrame, live: DataFrame, probe: Probe, site: Site = Site(), limits: Limits = Limits(), today: str = "") -> tuple[DataFrame, DataFrame, DataFrame]:
    """seed_run, and its candidates."""
    lost = history.first_missing(snapshots.select("path", "day").distinct(), "path", "day")
    kinds = snapshots.select("path", "kind").distinct()
    none = F.lit(None).cast("string")
    one = dedupe.first_per(lost.join(kinds, "path"), ["path"], [F.asc("kind")]).select("path", "kind", none.alias("parent"), none.alias("title"), F.lit("history").alias("evidence"), F.col("day").alias("firstSeen"))
    broken = validate.validate(links, caches, site).where("verdict = 'broken' and kind in ('module', 'unit', 'course', 'exam', 'certification')")
    two = broken.select("path", "kind", none.alias("parent"), none.alias("title"), F.lit("history").alias("evidence"), F.lit(today).alias("firstSeen")).distinct()
    candidates = ledger.merged_candidates([one, two], changes.select("path"), live)
    after = ledger.refresh(changes, candidates, live, "learn", today, probe, limits.probes)
    return after, ledger.compared(changes, after), candidates


def families_in_scope(families: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    return families.where(F.col("family").isin(*wanted)) if wanted else families.where("relevant")


def sitemap_pass(files: DataFrame, site: Site, host: str, memo: DataFrame, signature: str, today: str) -> tuple[DataFrame, DataFrame]:
    """(rows, memo) of downloaded sitemap files (family, xml; null xml: failed)."""
    from ..functions.paths import canonical_path, normal_page_url
    from ..functions.scalars import lastmod_or_null
    from ..functions.text import urlset

    raw = files.where("xml is not null").select("family", F.explode(urlset("xml")).alias("u")).select("family", normal_page_url("u.loc", host).alias("url"), lastmod_or_null("u.lastmod").alias("lastmod"))
    rows = raw.withColumn("path", canonical_path("url", host)).where("path is not null").where(in_scope("path", site.learn) | in_scope("path", site.index))
    outcomes = files.groupBy("family").agg(F.max(F.col("xml").isNull()).alias("failed")).join(rows.groupBy("family").agg(F.count("*").alias("rows")), "family", "left").na.fill({"rows": 0})
    return rows, build.update_families(memo, files, outcomes, signature, today)


def queue_budget(plan: DataFrame, limits: Limits = Limits(), today: str = "") -> DataFrame:
    """path, phase: the plan's queues within their budgets.

    quarantine: least recently checked first; fetch: changed before new, the
    freshest first; verify: the oldest check first; missing: see missing_batch.
    """
    rows = plan.withColumn("checked", F.col("prev_checked"))
    fetch = rows.where(F.col("action").isin(*docs.FETCH)).withColumn("kind", F.col("action"))
    parts = {
        "quarantine": queues.top(rows.where("action = 'quarantined'"), [F.asc(F.coalesce("q_lastChecked", F.lit(""))), F.asc("url"), F.asc("path")], limits.quarantine_rechecks),
        "fetch": queues.take_budget(fetch, limits.page_fetches, [F.desc_nulls_last("lastmod"), F.asc("path")], "kind", limits.changed_min_share),
        "verify": queues.top(rows.where(F.col("action").isin(*docs.VERIFY)), [F.asc_nulls_first("checked"), F.asc("url")], limits.verify),
        "missing": queues.missing_batch(rows.where("action = 'missing'"), limits.missing_checks, today),
    }
    return reduce(DataFrame.unionByName, [p.select("path", F.lit(phase).alias("phase")) for phase, p in parts.items()])


def sitemap_rounds(index_files: DataFrame, roots: DataFrame, most_rounds: int = 20) -> tuple[DataFrame, DataFrame]:
    """(pages, failed) of nested sitemap indexes: files reached from the roots, breadth first, each once.

    index_files (loc, xml): downloaded files, null xml where the download failed;
    roots (loc, family).  pages (family, loc, xml) are the files that list pages;
    failed (family, loc) those that were named and could not be read, or stood
    deeper than most_rounds.  A file that several families name belongs to each.
    """
    from ..functions.text import is_sitemap_index, sitemap_index

    files_ = index_files.select("loc", "xml")
    now = settled(roots.select("family", "loc").distinct())
    seen, pages, failed = now, None, None
    for turn in range(most_rounds + 1):
        read = now.join(files_, "loc", "left")
        good = F.col("xml").isNotNull()
        lists = good & is_sitemap_index("xml")
        pages_now = read.where(good & ~lists).select("family", "loc", "xml")
        failed_now = read.where(~good if turn < most_rounds else ~good | lists).select("family", "loc")
        pages, failed = (pages_now, failed_now) if pages is None else (pages.unionByName(pages_now), failed.unionByName(failed_now))
        below = read.where(lists).select("family", F.explode(sitemap_index("xml")).alias("s")).select("family", F.col("s.loc").alias("loc")).distinct()
        now = settled(below.join(seen, ["family", "loc"], "left_anti"))
        if turn == most_rounds or now.isEmpty():
            return pages, failed
        seen = seen.unionByName(now)
