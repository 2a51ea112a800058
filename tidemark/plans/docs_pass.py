"""The documentation run as a whole: plan, phases of probes, other sources, reconciliation, gates, ledger."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Limits, Site
from ..functions.paths import alias_key, scope_class
from ..functions.scalars import fnv32
from ..operators import classify, dedupe, docs, ledger, quality, queues
from ..sources.files import carried
from ..sources.shared import settled
from . import runs

#: Phases in their order: what keeps the index truthful goes before what refreshes records.
PHASES = ("quarantine", "missing", "fetch", "verify")
ANSWER = "phase string, key string, outcome string, status int, to string, title string, noindex boolean, at double"


@dataclass
class Phased:
    """Answers that count, how each phase was stopped (breaker or deadline), and how many requests it made."""

    answers: DataFrame
    stops: dict[str, str]
    requests: dict[str, int]

    @property
    def degraded(self) -> bool:
        return "breaker" in self.stops.values()


def phase_queue(plan: DataFrame, external: DataFrame, limits: Limits = Limits(), today: str = "") -> DataFrame:
    """phase, key, path, url, external, queue_pos: the queues of a plan within their budgets, each in its order.

    external (url, lastChecked): quarantined pages of other sites, whose key is
    their URL; they share the budget of the quarantine phase with the site's own.
    """
    chosen = runs.queue_budget(plan, limits, today).where("phase <> 'quarantine'").join(plan, "path")
    bare = ~F.col("has_record")
    order = {
        "missing": [F.when(bare, 1).otherwise(0), F.when(bare, F.lpad(fnv32(F.concat("path", F.lit(f"|{today}"))).cast("string"), 10, "0")).otherwise(F.coalesce("prev_checked", F.lit("")))],
        "fetch": [F.when(F.col("action") == "changed", 0).otherwise(1), F.translate(F.coalesce("lastmod", F.lit("")), "0123456789", "9876543210")],
        "verify": [F.lit(0), F.coalesce("prev_checked", F.lit(""))],
    }
    pick = lambda i: reduce(lambda held, p: held.when(F.col("phase") == p, order[p][i]), list(order)[1:], F.when(F.col("phase") == "missing", order["missing"][i]))
    rows = chosen.select("phase", F.col("path").alias("key"), "path", "url", F.lit(False).alias("external"), pick(0).cast("int").alias("_a"), pick(1).alias("_b"))
    own = plan.where("action = 'quarantined'").select(F.col("path").alias("key"), "path", "url", F.lit(False).alias("external"), F.coalesce("q_lastChecked", F.lit("")).alias("_b"))
    other = external.select(F.col("url").alias("key"), F.lit(None).cast("string").alias("path"), "url", F.lit(True).alias("external"), F.coalesce("lastChecked", F.lit("")).alias("_b"))
    held = queues.top(own.unionByName(other), [F.col("_b"), F.col("url"), F.col("key")], limits.quarantine_rechecks).withColumns({"phase": F.lit("quarantine"), "_a": F.lit(0)})
    each = Window.partitionBy("phase").orderBy("_a", "_b", "url", "key")
    return rows.unionByName(held.select(rows.columns)).withColumn("queue_pos", F.row_number().over(each).cast("long")).drop("_a", "_b")


def run_phases(queue: DataFrame, answer: Callable[[DataFrame], DataFrame], streak: int = 40, minutes: float = 0) -> Phased:
    """The phases one after the other, under one clock and a breaker each.

    answer takes a phase's queue and gives rows of ANSWER for what it asked, at
    being the seconds since the run began at which a request was due to start.
    What was due after the clock ran out, or behind `streak` transient answers in
    a row, did not run: it has no answer.  0: no breaker, no clock.
    """
    stops, requests, kept = {}, {}, []
    waiting = {r[0]: r[1] for r in queue.groupBy("phase").count().collect()}
    for phase in PHASES:
        if not waiting.get(phase):
            continue
        asked = queue.where(F.col("phase") == phase)
        told = dedupe.first_per(answer(asked).drop("phase"), ["key"], [F.asc_nulls_first("at"), F.asc("outcome")]).join(asked.select("phase", "key", "queue_pos"), "key")
        told = settled(told)
        late = F.col("at") >= 60 * minutes if minutes > 0 else None
        last, cause = queues.trip(told, "queue_pos", F.col("outcome") == "transient", streak, late)
        told = told if cause is None else told.where(F.col("queue_pos") <= last)
        requests[phase] = told.count()
        if cause:
            stops[phase] = cause
        kept.append(told)
    names = [c.split()[0] for c in ANSWER.split(", ")]
    none = queue.sparkSession.createDataFrame([], ANSWER)
    return Phased(reduce(DataFrame.unionByName, [k.select(names) for k in kept], none), stops, requests)


@dataclass
class DocsPass:
    """Tables as the run leaves them; what is not to be written is told by index_written."""

    records: DataFrame
    index: DataFrame
    quarantine: DataFrame
    redirects: DataFrame
    ledger: DataFrame
    states: DataFrame
    phases: Phased
    counts: dict[str, int]
    index_written: bool
    complete: bool
    #: Why the run counts as failed although its tables are good.
    failures: list[str] = field(default_factory=list)


def other_sources(previous: DataFrame, fresh: DataFrame | None, failed: DataFrame | None, source: str = "source") -> DataFrame:
    """Records of other sites: those of the run before where nothing was fetched; else the fresh ones, and the previous ones of sources that failed."""
    if fresh is None:
        return previous
    names = [c for c in previous.columns if c in fresh.columns]
    rows = fresh.select(names)
    if failed is not None:
        rows = carried(rows, previous.select(names), failed, source)
    return rows.select(*[(F.col(c) if c in names else F.lit(None).cast(previous.schema[c].dataType)).alias(c) for c in previous.columns])


def docs_pass(
    rows: DataFrame, catalogue: DataFrame, previous_index: DataFrame, quarantine: DataFrame, redirects: DataFrame, changes: DataFrame, answer: Callable[[DataFrame], DataFrame], today: str,
    site: Site = Site(), limits: Limits = Limits(), sitemap_ok: bool = True, git: DataFrame | None = None, git_failed: DataFrame | None = None, least_records: int = 20_000, kept_ratio: float = 0.6,
) -> DocsPass:
    """A run over a sitemap pass (url, path, lastmod), in memory of the run before.

    catalogue and quarantine are as in runs.docs_run; rows without a path are of
    other sites, and go by their URL.  answer: see run_phases.  git (url, title,
    and columns of the catalogue, with `source`): records fetched from other
    sources, null where none was asked; git_failed (source): sources that could
    not be read, whose previous records stay.

    A quarantined page of another site that answers is a record again; one that
    is gone keeps its place with a new check; any other answer changes nothing.
    Raises GateFailure, with nothing to be written, where the sitemap has far too
    few paths, where many URLs stand twice, or where fewer than kept_ratio of the
    records (least_records at least) would be left.  A failed source, a failed
    sitemap file and a tripped breaker are failures of a run that is written all
    the same; a clock that ran out is none.
    """
    spark = rows.sparkSession
    inside = rows.where(scope_class("path", site.learn, site.index).isNotNull())
    own, foreign = catalogue.where("path is not null"), catalogue.where("path is null")
    held, external = quarantine.where("path is not null"), dedupe.fold_quarantine(quarantine.where("path is null").drop("path"), "url")
    external = settled(external)
    sitemap = settled(dedupe.dedupe_rows(inside, dedupe.first_per(own.select("path", "url"), ["path"], [F.asc("url")])))
    if sitemap_ok:
        in_scope = lambda t: t.where(scope_class("path", site.learn, site.index).isNotNull()).select("path").distinct().count()
        quality.enforce(quality.index_gate(spark, sitemap.count(), quality.index_baseline(in_scope(previous_index), in_scope(own))))
    known = ledger.normal_redirects(redirects)
    plan = settled(docs.plan(sitemap, own, previous_index, held, known, today, site, limits.redirect_recheck_days, sitemap_ok))
    phases = run_phases(settled(phase_queue(plan, external, limits, today)), answer, limits.transient_streak, limits.runtime_minutes)
    told = settled(phases.answers)
    results = told.where(F.col("key").startswith("/")).withColumnRenamed("key", "path").drop("phase", "at")
    states = settled(docs.reconcile(plan, results, today, site))

    seen = external.join(told.where(~F.col("key").startswith("/")).select(F.col("key").alias("url"), F.col("outcome").alias("_o"), F.col("status").alias("_s")), "url", "left")
    gone = F.col("_o").eqNullSafe("gone")
    waits = seen.where(~F.col("_o").eqNullSafe("live")).withColumn("status", F.when(gone, F.col("_s")).otherwise(F.col("status"))).withColumn("lastChecked", F.when(gone, F.lit(today)).otherwise(F.col("lastChecked")))
    back = seen.where(F.col("_o") == "live")

    records = docs.records(states, own, sitemap, results, site)
    others = other_sources(foreign, git, git_failed)
    plain = lambda t: t.select(*[(F.col(c) if c in t.columns else F.lit(None)).cast(records.schema[c].dataType).alias(c) for c in records.columns])
    merged = settled(records.unionByName(plain(others)).unionByName(plain(back)))
    keyed = merged.withColumn("_alias", alias_key("url", site.host))
    n = merged.count()
    audit = quality.duplicates_gate(keyed, "url", "_alias")
    # first wins, by URL; the audit has passed only if there are few
    entries = dedupe.first_per(keyed, ["_alias"], [F.asc("url"), F.asc_nulls_last("path"), F.asc_nulls_last("title")]).drop("_alias")
    left = entries.count()
    quality.enforce(audit, quality.floor_gate(spark, "catalogue records", left, quality.size_floor(catalogue.count(), least_records, kept_ratio)))

    index = states.where("in_index").select("path", F.col("index_lastmod").alias("lastmod"))
    new = states.where("state = 'moved'").select(F.col("path").alias("from"), F.col("moved_to").alias("to"), classify.classify_redirect("path", "moved_to").alias("kind"), F.col("moved_status").alias("status"))
    moved = ledger.update_redirects(known, new, states.where("contradicted").select("path"), index, previous_index.select("path"), today, (site.learn, site.index))
    names = ["path", "url", "title", "status", "firstDetected", "lastChecked"]
    kept = states.where("quarantined").select(names)
    docs_entries = ledger.docs_entries(moved, kept, today)
    away = waits.withColumn("path", F.lit(None).cast("string")).select(names)
    counts = {r.name: r.n for r in docs.run_counts(states).collect()} | {"catalogRecords": left, "duplicatesDropped": n - left, "externalReleased": back.count()}
    counts["quarantined"] += waits.count()
    failures = [] if sitemap_ok else ["a sitemap file failed"]
    if git_failed is not None and not git_failed.isEmpty():
        failures.append("a source failed, its previous records were carried forward")
    failures += [f"the {p} phase hit the breaker" for p, why in phases.stops.items() if why == "breaker"]
    complete = sitemap_ok and not counts["deferredChanged"] and not counts["deferredMissing"] and not phases.degraded
    return DocsPass(entries, index, kept.unionByName(away), moved, ledger.replace_family(changes, "docs", docs_entries), states, phases, counts, sitemap_ok, complete, failures)
