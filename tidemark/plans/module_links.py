"""The run that keeps the links of modules' last units: harvest, carry forward by signature, clean, gates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Site
from ..functions.scalars import days_between, is_iso_date, refresh_due
from ..operators import quality, queues
from ..operators.classify import decide_offline, decide_probe, link_kind
from ..operators.dedupe import first_per
from ..sources.shared import dealt, settled, tasks_for
from .validate import Caches, validate

RECORDS = "path string, unitSig string, unit string, unitTitle string, harvestedAt string"
LINKS = "module string, pos int, kind string, path string, url string, text string, section string, was string, checked string, unverified boolean"
#: Kinds of links whose target is a page of the site, and can be checked.
CHECKED = ("docs", "training", "learn-other")


@dataclass(frozen=True)
class LinkLimits:
    """Fixed values of the run: budgets, days between full passes and between checks of a link, and the gates."""

    fetches: int = 4000
    refresh_days: int = 30
    probes: int = 3000
    recheck_days: int = 30
    least_sample: int = 20
    breaker: int = 50
    chunk: int = 100
    probe_chunk: int = 50
    most_failed: float = 10
    most_layout: float = 10
    least_kept: float = 70
    least_before: int = 50
    most_unknown: float = 20
    most_dropped: float = 30
    least_modules: int = 0


@dataclass
class LinkRun:
    """Records and links as the run leaves them, and what it did."""

    records: DataFrame
    links: DataFrame
    plan: DataFrame
    #: Day of the last pass over all modules that left none out.
    full_at: str | None
    counts: dict[str, int] = field(default_factory=dict)


def plan(modules: DataFrame, scope: DataFrame, records: DataFrame, full: bool, most: int) -> DataFrame:
    """path, unit, action for every module in scope: fetch, wait (beyond the budget), no-units, or keep.

    New modules go first, then those whose signature has changed, then, on a full
    pass, the others; the longest unharvested first.
    """
    old = records.select("path", F.col("unitSig").alias("_sig"), F.coalesce("harvestedAt", F.lit("")).alias("harvestedAt"))
    rows = modules.select("path", "unitSig", "unitUrls").join(scope.select("path").distinct(), "path", "left_semi").join(old, "path", "left")
    usable = (F.size(F.coalesce("unitUrls", F.array().cast("array<string>"))) > 0) & (F.coalesce("unitSig", F.lit("")) != "")
    rank = F.when(~usable, -1).when(F.col("_sig").isNull(), 0).when(F.col("_sig") != F.col("unitSig"), 1).when(F.lit(full), 2)
    rows = settled(rows.select("path", "unitSig", F.get("unitUrls", F.size("unitUrls") - 1).alias("unit"), rank.alias("rank"), F.coalesce("harvestedAt", F.lit("")).alias("harvestedAt")))
    chosen = queues.top(rows.where("rank >= 0"), [F.col("rank"), F.col("harvestedAt"), F.col("path")], most).select("path", F.lit(True).alias("_now"))
    action = F.when(F.col("rank") < 0, "no-units").when(F.col("_now"), "fetch").when(F.col("rank").isNotNull(), "wait").otherwise("keep")
    return rows.join(chosen, "path", "left").select("path", "unitSig", "unit", "rank", "harvestedAt", action.alias("action"))


def carried(modules: DataFrame, scope: DataFrame, records: DataFrame, fetched: DataFrame, failed: DataFrame) -> DataFrame:
    """Records (and `fresh`) after a harvest: fetched ones replace old ones; a module that failed keeps its record only while its signature is unchanged.

    fetched (as RECORDS), failed (path).  Modules out of scope or out of the catalogue lose their record.
    """
    now = modules.select("path", F.col("unitSig").alias("_now")).join(scope.select("path").distinct(), "path", "left_semi")
    old = records.join(now, "path").join(failed.select("path", F.lit(True).alias("_failed")).distinct(), "path", "left")
    old = old.where(F.col("_failed").isNull() | F.col("unitSig").eqNullSafe(F.col("_now"))).join(fetched.select("path"), "path", "left_anti")
    names = [c.split()[0] for c in RECORDS.split(", ")]
    return old.select(*names, F.lit(False).alias("fresh")).unionByName(fetched.select(*names, F.lit(True).alias("fresh")))


def probe_plan(links: DataFrame, undecided: DataFrame, today: str, recheck_days: int, most: int) -> DataFrame:
    """path, action of targets that the caches cannot settle: fresh (confirmed not long ago), probe (never checked first, then the longest ago) or wait."""
    seen = links.where(is_iso_date("checked") & ~F.coalesce("unverified", F.lit(False))).groupBy("path").agg(F.max("checked").alias("checked"))
    rows = settled(undecided.select("path").distinct().join(seen, "path", "left"))
    fresh = F.coalesce(days_between("checked", F.lit(today)) <= recheck_days, F.lit(False))
    chosen = queues.top(rows.where(~fresh), [F.coalesce("checked", F.lit("")), F.col("path")], most).select("path", F.lit("probe").alias("_now"))
    return rows.join(chosen, "path", "left").select("path", F.when(fresh, "fresh").otherwise(F.coalesce("_now", F.lit("wait"))).alias("action"))


def applied(links: DataFrame, decisions: DataFrame, today: str) -> DataFrame:
    """Links after the decisions (path, decision, via, to) on their targets, with `decision`; dropped ones stay, so that they can be counted.

    Links of a module that come to one target are one, the first; a rewritten
    link keeps the oldest `was`.  External links are left alone, once a module.
    Only a live check, or an earlier one that is still fresh, dates a link.
    """
    told = decisions.select("path", "decision", "via", F.col("to").alias("_to"))
    tasks = tasks_for(links)
    rows = dealt(links.drop("unverified"), tasks, "path").join(told, "path", "left")
    checked = F.col("kind").isin(*CHECKED)
    decision = F.when(checked, F.coalesce("decision", F.lit("keep"))).otherwise("external")
    rewritten = decision == "rewrite"
    path = F.when(rewritten, F.col("_to")).otherwise(F.col("path"))
    by_probe = decision.isin("keep", "rewrite") & F.col("via").eqNullSafe("probe")
    day = F.when(~checked | ((decision == "keep") & F.col("via").eqNullSafe("fresh")), F.col("checked")).when(by_probe, F.lit(today))
    rows = rows.select(
        "module", "pos",
        F.when(rewritten, link_kind(path)).otherwise(F.col("kind")).alias("kind"),
        path.alias("path"), "url", "text", "section",
        F.when(rewritten, F.coalesce("was", "path")).otherwise(F.col("was")).alias("was"),
        day.alias("checked"), (decision == "unverified").alias("unverified"), decision.alias("decision"), "via",
    )
    gone = rows.where("decision = 'drop'")
    key = F.when(F.col("kind").isin(*CHECKED), F.concat(F.lit("p"), F.coalesce("path", F.lit("")))).otherwise(F.concat(F.lit("u"), F.coalesce("url", "path", F.lit(""))))
    left = first_per(dealt(rows.where("decision <> 'drop'").withColumn("_key", key), tasks, "module", "_key"), ["module", "_key"], [F.asc("pos")]).drop("_key")
    return left.unionByName(gone)


def cleaned(links: DataFrame, caches: Caches, probe: Callable[[DataFrame], DataFrame], today: str, limits: LinkLimits = LinkLimits(), site: Site = Site()) -> tuple[DataFrame, dict[str, int], bool]:
    """(links with their decision, counts, whether the checks broke off): targets settled by the caches, else by live checks.

    probe takes (path, queue_pos) and gives (path, verdict, redirects_to).
    Targets beyond the budget, without an answer, or behind a break are unverified.
    """
    targets = links.where(F.col("kind").isin(*CHECKED) & F.col("path").isNotNull()).select("path").distinct()
    verdicts = validate(targets.withColumn("url", F.col("path")), caches, site, url="url").select("path", "verdict", "redirects_to", "confidence")
    known = settled(verdicts.select("path", decide_offline(F.col("path"), F.col("verdict"), F.col("redirects_to"), F.col("confidence")).alias("decision"), F.lit("cache").alias("via"), F.col("redirects_to").alias("to")))
    known, undecided = known.where("decision is not null"), targets.join(known.where("decision is not null"), "path", "left_anti")
    todo = settled(probe_plan(links, undecided, today, limits.recheck_days, limits.probes))
    queue = queues.numbered(todo.where("action = 'probe'").select("path"), "path")
    told = probe(queue).select("path", decide_probe(F.col("path"), F.col("verdict"), F.col("redirects_to")).alias("decision"), F.col("redirects_to").alias("to"))
    told = settled(first_per(told, ["path"], [F.asc("decision"), F.asc_nulls_last("to")]).join(queue, "path"))
    told, broke = queues.before_half_failed(told, "queue_pos", F.col("decision") == "unverified", limits.breaker, limits.probe_chunk)
    n = {r[0]: r[1] for r in told.groupBy("decision").count().collect()}
    rest = todo.join(told.select("path"), "path", "left_anti")
    none = F.lit(None).cast("string").alias("to")
    decisions = (
        known.unionByName(told.select("path", "decision", F.lit("probe").alias("via"), "to"))
        .unionByName(rest.where("action = 'fresh'").select("path", F.lit("keep").alias("decision"), F.lit("fresh").alias("via"), none))
        .unionByName(rest.where("action <> 'fresh'").select("path", F.lit("unverified").alias("decision"), F.lit("budget").alias("via"), none))
    )
    return applied(links, decisions, today), {"probed": sum(n.values()), "unknown": n.get("unverified", 0), "dropped": n.get("drop", 0)}, broke


def module_link_run(
    modules: DataFrame, scope: DataFrame, records: DataFrame, links: DataFrame, full_at: str | None, fetch: Callable[[DataFrame], DataFrame], caches: Caches, probe: Callable[[DataFrame], DataFrame], today: str,
    limits: LinkLimits = LinkLimits(), site: Site = Site(), first: bool = False, full: bool = False,
) -> LinkRun:
    """A run over the modules (path, unitUrls, unitSig) of a scope (path), from the records and links of the run before (RECORDS, LINKS).

    fetch takes (path, unit, queue_pos) and gives (path, outcome ok / layout /
    else, unitTitle, links array of structs kind, path, url, text, section);
    modules it leaves out count as not asked.  full_at is the day of the last
    full pass: when it is longer ago than refresh_days, all modules are read
    again.  first: there was no run before.  Raises GateFailure, with nothing to
    be written, where reading, layout, checks or links fail too often.
    """
    spark = modules.sparkSession
    inside = settled(modules.join(scope.select("path").distinct(), "path", "left_semi").select("path", "unitUrls", "unitSig"))
    whole = full or (not first and bool(spark.range(1).select(refresh_due(F.lit(full_at).cast("string"), today, limits.refresh_days).alias("due")).first().due))
    planned = settled(plan(inside, inside, records, whole, limits.fetches))
    todo = queues.numbered(planned.where("action = 'fetch'"), "rank", "harvestedAt", "path").select("path", "unit", "unitSig", "queue_pos")
    told = settled(fetch(todo.select("path", "unit", "queue_pos")).join(todo, "path").select("path", "outcome", "unitTitle", "links", "unit", "unitSig", "queue_pos"))
    told, broke = queues.before_half_failed(told, "queue_pos", F.coalesce(F.col("outcome") != "ok", F.lit(True)), limits.breaker, limits.chunk)
    n = {r[0]: r[1] for r in told.groupBy("outcome").count().collect()}
    asked, layout = sum(n.values()), n.get("layout", 0)
    failed = asked - layout - n.get("ok", 0)
    got = told.where("outcome = 'ok'")
    fetched = got.select("path", "unitSig", "unit", "unitTitle", F.lit(today).alias("harvestedAt"))
    kept = settled(carried(inside, inside, records, fetched, told.where("outcome is null or outcome <> 'ok'")))
    none = F.lit(None).cast("string")
    new = got.select(F.col("path").alias("module"), F.posexplode("links").alias("pos", "l")).select("module", "pos", *[F.col(f"l.{c}").alias(c) for c in ("kind", "path", "url", "text", "section")], none.alias("was"), none.alias("checked"), F.lit(False).alias("unverified"))
    old = links.join(kept.where("not fresh").select(F.col("path").alias("module")), "module", "left_semi")
    done, checks, stopped = cleaned(settled(old.select(new.columns).unionByName(new)), caches, probe, today, limits, site)
    done = settled(done)
    final = done.where("decision <> 'drop'").drop("decision", "via")
    counts = {f"links_{r[0]}": r[1] for r in done.groupBy("decision").count().collect()} | checks
    had = links.join(inside.select(F.col("path").alias("module")), "module", "left_semi").select("module").distinct().count()
    has = final.select("module").distinct().count()
    gates = [
        quality.floor_gate(spark, "modules in scope", inside.count(), limits.least_modules),
        quality.ratio_gate(spark, "unit pages that could not be read", failed, asked, limits.most_failed, limits.least_sample),
        quality.ratio_gate(spark, "unit pages without unit content", layout, asked - failed, limits.most_layout, limits.least_sample),
        quality.ratio_gate(spark, "live checks without a result", checks["unknown"], checks["probed"], limits.most_unknown, limits.least_sample),
        quality.ratio_gate(spark, "live checks that found nothing", checks["dropped"], checks["probed"], limits.most_dropped, limits.least_sample),
    ]
    if had >= limits.least_before:
        gates.append(quality.kept_gate(spark, "modules with links", had, has, limits.least_kept))
    if broke or stopped:
        gates.append(quality.gate(spark, "breaker", asked, limits.breaker, False, f"stopped after {asked} pages and {checks['probed']} checks: more than half failed"))
    quality.enforce(*gates)
    waiting = planned.where("action = 'wait'").count()
    through = (whole or first) and not waiting and not failed and not layout
    counts |= {"asked": asked, "failed": failed + layout, "waiting": waiting, "fetched": n.get("ok", 0), "with_links": has}
    return LinkRun(kept.drop("fresh"), final, planned, today if through else full_at, counts)
