"""The change ledger: validation, the apply step, redirects, summaries."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CHANGE_FILES, CLASSIFIED, COVERING, EVIDENCE, EVIDENCE_PRIORITY, FAMILIES, KINDS, MAX_ROUNDS, MOVED_OUTCOMES, REMOVED_OUTCOMES, LedgerError, Scope
from ..functions.paths import canonical_path, entry_path, in_scope, present
from ..functions.scalars import family_of_kind, is_iso_date, text_or_null
from ..sources.shared import settled
from .dedupe import first_per, prefer_entry
from .joins import paths_below

ENTRY = "file string, path string, kind string, family string, outcome string, to string, title string, parent string, firstSeen string, lastVerified string, evidence string, status int"
COLUMNS = [c.split()[0] for c in ENTRY.split(", ")]


def file_of(outcome: Column | str) -> Column:
    o = F.col(outcome) if isinstance(outcome, str) else outcome
    return F.when(o.isin(*MOVED_OUTCOMES), "moved").otherwise("removed")


def checked_entries(raw: DataFrame, host: str | None = None) -> DataFrame:
    """Entries in normal form with `problem`: null, or why the row cannot be used."""
    path = entry_path("path", host)
    outcomes = F.when(F.col("file") == "moved", F.col("outcome").isin(*MOVED_OUTCOMES)).otherwise(F.col("outcome").isin(*REMOVED_OUTCOMES))
    problem = (
        F.when(path.isNull(), "path")
        .when(~F.coalesce(F.col("file").isin(*CHANGE_FILES), F.lit(False)), "file")
        .when(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)), "kind")
        .when(~F.coalesce(outcomes, F.lit(False)), "outcome")
        .when(~is_iso_date("firstSeen"), "firstSeen")
        .when(~F.coalesce(F.col("evidence").isin(*EVIDENCE), F.lit(False)), "evidence")
        .when(F.col("to").isNotNull() & canonical_path("to", host).isNull(), "to")
    )
    return raw.withColumns(
        {
            "problem": problem,
            "path": path,
            "family": family_of_kind("kind"),
            "to": canonical_path("to", host),
            "title": text_or_null("title"),
            "parent": entry_path("parent", host),
            "lastVerified": F.when(is_iso_date("lastVerified"), F.col("lastVerified")),
            "status": F.when(F.col("status").between(100, 599), F.col("status")),
        }
    )


def normal_ledger(raw: DataFrame, host: str | None = None, strict: bool = False) -> DataFrame:
    """One valid entry per path.  Bad rows are left out, or, if strict, an error."""
    rows = checked_entries(raw, host)
    if strict:
        bad = rows.where("problem is not null").limit(3).collect()
        if bad:
            raise LedgerError("; ".join(f"{r.path}: bad {r.problem}" for r in bad))
    return prefer_entry(rows.where("problem is null").select(COLUMNS))


def clean_candidates(candidates: DataFrame, family: str, host: str | None = None) -> DataFrame:
    """The valid candidates of a family, one per path: by kind, then the strongest evidence, then the first by `ordinal`, if there is one.

    Paths and parents are canonical; rows with a path, kind or evidence that
    cannot be used, or of the other family, are left out; a bad firstSeen is null.
    """
    valid = F.col("kind").isin(*KINDS) & (family_of_kind("kind") == family) & F.col("evidence").isin(*EVIDENCE)
    rows = candidates.where(valid).withColumn("path", present(entry_path("path", host))).withColumns({"parent": entry_path("parent", host), "title": text_or_null("title"), "firstSeen": F.when(is_iso_date("firstSeen"), F.col("firstSeen"))})
    rank = F.array_position(F.array(*map(F.lit, EVIDENCE_PRIORITY)), F.col("evidence"))
    given = [F.asc("ordinal")] if "ordinal" in candidates.columns else []
    rows = first_per(rows, ["path"], [F.asc("kind"), rank.asc(), *given, F.asc_nulls_last("firstSeen"), F.asc_nulls_last("title"), F.asc_nulls_last("parent")])
    return rows.select("path", "kind", "parent", "title", "evidence", "firstSeen")


def last_results(results: DataFrame, host: str | None = None) -> DataFrame:
    """One result per canonical path: the last by `ordinal`, if there is one, else the first of a fixed order of outcomes."""
    seen = results.withColumn("path", present(entry_path("path", host)))
    given = [F.desc("ordinal")] if "ordinal" in results.columns else []
    return first_per(seen, ["path"], [*given, F.asc_nulls_last("outcome"), F.asc_nulls_last("to"), F.asc_nulls_last("status")]).select("path", "outcome", "to", "status")


@dataclass
class Applied:
    """A ledger after a step, and the paths that left it: valid again, or covered by their module."""

    ledger: DataFrame
    resurrected: DataFrame
    covered: DataFrame


def apply_changes(ledger: DataFrame, candidates: DataFrame, results: DataFrame, live: DataFrame, family: str, today: str, host: str | None = None) -> DataFrame:
    """The ledger of apply_detailed."""
    return apply_detailed(ledger, candidates, results, live, family, today, host).ledger


def apply_detailed(ledger: DataFrame, candidates: DataFrame, results: DataFrame, live: DataFrame, family: str, today: str, host: str | None = None) -> Applied:
    """One step of a family's entries: resurrect, upsert, apply probe results, collapse covered units, route to files.

    candidates (path, kind, parent, title, evidence, firstSeen), results (path,
    outcome, to, status), live (path); candidates and results may have an
    ordinal, see clean_candidates and last_results.  A candidate fills the title
    and the parent of a known entry, and never dates it anew; a result sets
    outcome, status, and the destination of all that is not gone; a result
    'live' takes its path out.  Transient results change nothing, a second run
    with the same input gives the same ledger, and the order of rows does not
    matter.  No path of the family stands twice afterwards, whatever the input;
    bad entries are left out.  The other family passes through.
    """
    if family not in FAMILIES or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", today):
        raise LedgerError(f"a run needs a family ({', '.join(FAMILIES)}) and a day, not {family!r} and {today!r}")
    mine, other = ledger.where(F.col("family") == family), ledger.where(F.col("family") != family)
    return _applied(normal_ledger(mine, host), other, clean_candidates(candidates, family, host), last_results(results, host), live, family, today, host)


def _applied(mine: DataFrame, other: DataFrame, candidates: DataFrame, results: DataFrame, live: DataFrame, family: str, today: str, host: str | None) -> Applied:
    """apply_detailed for entries, candidates and results in normal form."""
    vouched = live.select("path").where("path is not null").distinct().withColumn("_live", F.lit(True))
    new = candidates.select("path", *[F.col(c).alias(f"c_{c}") for c in ("kind", "parent", "title", "evidence", "firstSeen")])
    seen = results.select("path", F.col("outcome").alias("r_outcome"), F.col("to").alias("r_to"), F.col("status").alias("r_status"))
    rows = mine.join(new, "path", "full").join(seen, "path", "left").join(vouched, "path", "left")
    back = F.coalesce(F.col("_live"), F.lit(False)) | F.col("r_outcome").eqNullSafe("live")
    resurrected = rows.where(back & F.col("kind").isNotNull()).select("path")
    fresh, told = F.col("kind").isNull(), F.coalesce(F.col("r_outcome").isin(*CLASSIFIED), F.lit(False))
    outcome = F.when(told, F.col("r_outcome")).otherwise(F.coalesce("outcome", F.lit("unverified")))
    rows = rows.where(~back).select(
        file_of(outcome).alias("file"),
        "path",
        F.coalesce("kind", "c_kind").alias("kind"),
        F.lit(family).alias("family"),
        outcome.alias("outcome"),
        F.when(told, F.when(F.col("r_outcome") != "gone", canonical_path("r_to", host))).otherwise(F.col("to")).alias("to"),
        F.coalesce("title", "c_title").alias("title"),
        F.coalesce("parent", "c_parent").alias("parent"),
        F.when(fresh, F.coalesce("c_firstSeen", F.lit(today))).otherwise(F.col("firstSeen")).alias("firstSeen"),
        F.when(told, F.lit(today)).otherwise(F.col("lastVerified")).alias("lastVerified"),
        F.coalesce("evidence", "c_evidence").alias("evidence"),
        F.when(told, F.col("r_status")).otherwise(F.col("status")).cast("int").alias("status"),
    )
    rows = settled(rows)  # read three times below
    covering = rows.where(F.col("kind") == "module").where(F.col("outcome").isin(*COVERING)).select("path")
    covered = paths_below(rows.where("kind = 'unit'"), covering)
    left = rows.join(covered, "path", "left_anti")
    return Applied(other.select(COLUMNS).unionByName(left.select(COLUMNS)), resurrected, covered)


@dataclass
class Refreshed:
    """A ledger after its probes, all results they gave, and what happened."""

    ledger: DataFrame
    results: DataFrame
    new_removed: int
    new_moved: int
    resurrected: int
    covered: int
    unverified: int
    probed: int
    transient: int
    budget_exhausted: bool
    stopped_early: bool


def refresh(ledger: DataFrame, candidates: DataFrame, live: DataFrame, family: str, today: str, probe, limit: int, **more) -> DataFrame:
    """The ledger of refresh_detailed."""
    return refresh_detailed(ledger, candidates, live, family, today, probe, limit, **more).ledger


def refresh_detailed(
    ledger: DataFrame, candidates: DataFrame, live: DataFrame, family: str, today: str, probe, limit: int,
    reverify: int = 100, dead: DataFrame | None = None, rounds: int = MAX_ROUNDS, streak: int = 0, host: str | None = None,
) -> Refreshed:
    """Rounds of queue, probe and apply, until nothing is left to ask, the budget is spent, or `rounds` are over.

    probe takes (path, kind, reason, queue_pos) rows and gives (path, outcome,
    to, status).  Every round applies all results so far to the ledger as it was
    before the run, so what one round leaves out (units under a module that
    turns out to be live) is there again in the next.  `limit` holds for the
    whole run; entries already answered are left out before the queue is ranked;
    only the first round verifies known entries again, at most `reverify`.  Paths
    without an answer stay as they are, and end the rounds: the probe has
    stopped.  With `streak`, so do as many transient answers in a row, and answers
    behind them do not count.  dead: paths known to be no longer live.

    Ledger, candidates, results and each round's ledger are kept in the shared
    folder: probes are not asked twice.  The driver gets counts alone.
    """
    from .queues import before_trip, plan_verification

    spark = ledger.sparkSession
    if family not in FAMILIES or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", today):
        raise LedgerError(f"a run needs a family ({', '.join(FAMILIES)}) and a day, not {family!r} and {today!r}")
    other = ledger.where(F.col("family") != family)
    base = settled(normal_ledger(ledger.where(F.col("family") == family), host))
    found = settled(clean_candidates(candidates, family, host))
    live = settled(live.select("path").distinct())
    results = spark.createDataFrame([], "path string, outcome string, to string, status int")
    probed = transient = 0
    exhausted = stopped = False

    def applied() -> Applied:
        step = _applied(base, other, found, results, live, family, today, host)
        return Applied(settled(step.ledger), step.resurrected, step.covered)

    now = applied()
    for turn in range(rounds):
        queue, wanted = plan_verification(now.ledger, today, limit - probed, reverify if turn == 0 else 0, dead, results.select("path"))
        exhausted |= wanted > max(0, limit - probed)
        queue = settled(queue)
        asked = queue.count()
        if not asked:
            break
        told = last_results(probe(queue), host).join(queue.select("path", "queue_pos"), "path")
        if streak:
            told = before_trip(settled(told), "queue_pos", F.col("outcome") == "transient", streak)
        told = settled(told.select("path", "outcome", "to", F.col("status").cast("int").alias("status")))
        n = {r[0]: r[1] for r in told.groupBy("outcome").count().collect()}
        probed, transient = probed + sum(n.values()), transient + n.get("transient", 0)
        stopped = sum(n.values()) < asked
        results = results.unionByName(told)
        now = applied()
        if stopped:
            break
    mine = now.ledger.where(F.col("family") == family)
    new = {r[0]: r[1] for r in mine.join(base.select("path", "file"), ["path", "file"], "left_anti").groupBy("file").count().collect()}
    waiting = mine.where("outcome = 'unverified'").count()
    return Refreshed(now.ledger, results, new.get("removed", 0), new.get("moved", 0), now.resurrected.count(), now.covered.count(), waiting, probed, transient, exhausted, stopped)


def replace_family(ledger: DataFrame, family: str, entries: DataFrame) -> DataFrame:
    """The ledger with one family's entries exchanged."""
    return ledger.where(F.col("family") != family).select(COLUMNS).unionByName(entries.where(F.col("family") == family).select(COLUMNS))


def docs_entries(redirects: DataFrame, quarantine: DataFrame, today: str) -> DataFrame:
    """Entries of the docs family from redirects (from, to, kind, status, firstSeen, lastSeen) and quarantined pages."""
    none = F.lit(None).cast("string")
    r = redirects.select(F.col("from").alias("path"), F.col("kind").alias("outcome"), "to", none.alias("title"), "firstSeen", F.col("lastSeen").alias("lastVerified"), F.lit("docs-redirect").alias("evidence"), "status", F.lit(1).alias("_o"))
    q = quarantine.select("path", F.lit("gone").alias("outcome"), none.alias("to"), "title", F.coalesce("firstDetected", F.lit(today)).alias("firstSeen"), F.col("lastChecked").alias("lastVerified"), F.lit("quarantine").alias("evidence"), "status", F.lit(0).alias("_o"))
    one = first_per(r.unionByName(q), ["path"], [F.desc(F.coalesce("lastVerified", F.lit(""))), F.asc("_o")])
    return one.select(file_of("outcome").alias("file"), "path", F.lit("docs").alias("kind"), F.lit("docs").alias("family"), "outcome", "to", "title", none.alias("parent"), "firstSeen", "lastVerified", "evidence", F.col("status").cast("int"))


def normal_redirects(rows: DataFrame, host: str | None = None) -> DataFrame:
    """Valid redirects, the last seen per start."""
    start = entry_path("from", host)
    good = rows.withColumn("from", start).withColumn("to", canonical_path("to", host)).where(start.isNotNull() & F.col("kind").isin("moved", "landing", "retired"))
    return first_per(good, ["from"], [F.desc_nulls_last("lastSeen"), F.asc("kind"), F.asc_nulls_last("to")])


def update_redirects(previous: DataFrame, discovered: DataFrame, contradicted: DataFrame, index: DataFrame, previous_index: DataFrame, today: str, scopes: tuple[Scope, ...] = ()) -> DataFrame:
    """Redirects without those that reappeared in the index, were contradicted by a probe or left the scope, and with those discovered.

    A path reappears when the index has it and the previous index had not; an
    empty previous index proves nothing.  Known ones keep their firstSeen.  With
    scopes, starts outside all of them go; a path that leads to itself is none.
    """
    if scopes:
        inside = reduce(or_, (in_scope("from", s) for s in scopes))
        previous, discovered = previous.where(inside), discovered.where(inside)
    discovered = discovered.where(~F.col("from").eqNullSafe(F.col("to")))
    back = index.select(F.col("path").alias("from")).join(previous_index.select(F.col("path").alias("from")), "from", "left_anti")
    if previous_index.isEmpty():
        back = back.limit(0)
    kept = previous.join(back, "from", "left_anti").join(contradicted.select(F.col("path").alias("from")), "from", "left_anti")
    new = discovered.select("from", F.col("to").alias("n_to"), F.col("kind").alias("n_kind"), F.col("status").alias("n_status"), F.lit(True).alias("_new"))
    rows = kept.join(new, "from", "full")
    pick = lambda n, o: F.when(F.col("_new"), F.col(n)).otherwise(F.col(o))
    return rows.select("from", pick("n_to", "to").alias("to"), pick("n_kind", "kind").alias("kind"), pick("n_status", "status").alias("status"), F.coalesce("firstSeen", F.lit(today)).alias("firstSeen"), F.when(F.col("_new"), F.lit(today)).otherwise(F.col("lastSeen")).alias("lastSeen"))


def changes_since(ledger: DataFrame, since: str) -> DataFrame:
    """Entries first seen on or after a day, oldest first."""
    return ledger.where(F.col("firstSeen") >= since).orderBy("firstSeen", "path")


def summary(ledger: DataFrame) -> DataFrame:
    """dimension, name, file, n: counts by file, outcome, kind and family, zeros included."""
    spark = ledger.sparkSession
    names = [("total", "all")] + [("outcome", o) for o in (*REMOVED_OUTCOMES, *MOVED_OUTCOMES)] + [("kind", k) for k in KINDS] + [("family", f) for f in FAMILIES]
    frame = spark.createDataFrame([(d, n, f) for d, n in names for f in CHANGE_FILES], "dimension string, name string, file string")
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), c.alias("name")) for d, c in (("total", F.lit("all")), ("outcome", F.col("outcome")), ("kind", F.col("kind")), ("family", F.col("family")))]))
    n = ledger.select("file", each.alias("e")).groupBy("e.dimension", "e.name", "file").agg(F.count("*").alias("n"))
    return frame.join(n, ["dimension", "name", "file"], "left").select("dimension", "name", "file", F.coalesce("n", F.lit(0)).alias("n"))


def compared(before: DataFrame, after: DataFrame) -> DataFrame:
    """change, n: entries added (by outcome), reclassified, dropped and kept between two ledgers."""
    a, b = before.select("path", F.col("outcome").alias("_a")), after.select("path", F.col("outcome").alias("_b"))
    change = F.when(F.col("_a").isNull(), F.concat(F.lit("added:"), "_b")).when(F.col("_b").isNull(), "dropped").when(F.col("_a") != F.col("_b"), "reclassified").otherwise("kept")
    return a.join(b, "path", "full").groupBy(change.alias("change")).agg(F.count("*").alias("n"))


def without_unconfirmed(ledger: DataFrame, paths: DataFrame, known: DataFrame) -> DataFrame:
    """Entries without those of a path set that are new and still unverified."""
    doubt = paths.select("path").join(known.select("path"), "path", "left_anti").withColumn("_d", F.lit(True)).distinct()
    return ledger.join(doubt, "path", "left").where("_d is null or outcome <> 'unverified'").drop("_d")


def merged_candidates(sources: list[DataFrame], known: DataFrame, live: DataFrame) -> DataFrame:
    """Candidates of several sources, the first source that names a path wins; known and live paths are left out."""
    rows = None
    for i, s in enumerate(sources):
        part = s.withColumn("_s", F.lit(i))
        rows = part if rows is None else rows.unionByName(part)
    rows = first_per(rows, ["path"], [F.asc("_s"), F.asc("kind"), F.asc_nulls_last("title")]).drop("_s")
    return rows.join(known.select("path").distinct(), "path", "left_anti").join(live.select("path").distinct(), "path", "left_anti")
