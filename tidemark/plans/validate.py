"""The flagship plan: a verdict for every link, from cached tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Site
from ..functions.paths import absolute, canonical_path, first_segment, last_segment, parent_path, scope_for
from ..operators.classify import classify_known
from ..operators.joins import lookup_changes, suggest_slug
from ..sources.shared import dealt, tasks_for

#: Content kinds and the type of their rows in the content table.
CONTENT = {"path": "learningPath", "course": "course", "certification": "certification", "exam": "exam", "applied-skill": "appliedSkill", "study-guide": "studyGuide"}
#: Kinds of which the catalogue lists only a part: absence proves nothing.
PARTIAL = ("certification", "exam", "study-guide")


@dataclass
class Caches:
    """Tables; None is a missing file, which makes its links unverifiable, never broken.

    modules (path, unitUrls, hierarchyNotFound), modules_removed (path,
    removedOn), out_of_scope (path), content (type, path), content_removed
    (path, removedOn), index (path), redirects (from, to, kind, firstSeen),
    quarantine (path, status, firstDetected), ledger (see operators.ledger).
    """

    modules: DataFrame | None = None
    modules_removed: DataFrame | None = None
    out_of_scope: DataFrame | None = None
    content: DataFrame | None = None
    content_removed: DataFrame | None = None
    index: DataFrame | None = None
    redirects: DataFrame | None = None
    quarantine: DataFrame | None = None
    ledger: DataFrame | None = None


#: Table, its key, the flag of its paths, and what else a path has there.
FACTS = (
    ("modules", "path", "_module", {"_served": ("hierarchyNotFound", "boolean"), "_units": ("unitUrls", "array<string>")}),
    ("modules_removed", "path", "_tomb", {}),
    ("out_of_scope", "path", "_outside", {}),
    ("content", "path", "_any_content", {"_types": ("type", "string")}),
    ("content_removed", "path", "_content_tomb", {}),
    ("index", "path", "_indexed", {}),
    ("redirects", "from", "_redirect", {"_to": ("to", "string")}),
    ("quarantine", "path", "_held", {}),
)


def _listed(caches: Caches) -> DataFrame | None:
    """Every path of every table, with the table's flag."""
    flags, more = [f for _, _, f, _ in FACTS], {n: t for *_, m in FACTS for n, (_, t) in m.items()}
    parts = []
    for table, key, flag, columns in FACTS:
        df = getattr(caches, table)
        if df is not None:
            filled = [F.lit(True).alias(f) if f == flag else F.lit(None).cast("boolean").alias(f) for f in flags]
            parts.append(df.select(F.col(key).alias("_k"), *filled, *[(F.col(columns[n][0]).cast(t) if n in columns else F.lit(None).cast(t)).alias(n) for n, t in more.items()]))
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts).where("_k is not null")


def known_paths(caches: Caches, tasks: int = 0) -> DataFrame | None:
    """One row for every path in any table, with its flags: all tables meet in one aggregate by path, in so many tasks at least.

    Of a path that a table has twice, the greatest values count (content: all types).
    """
    rows = _listed(caches)
    if rows is None:
        return None
    rows, flags, more = dealt(rows, tasks, "_k"), [f for _, _, f, _ in FACTS], [n for *_, m in FACTS for n in m]
    return rows.groupBy("_k").agg(*[F.max(f).alias(f) for f in flags], *[(F.collect_set(n) if n == "_types" else F.max(n)).alias(n) for n in more])


def validate(links: DataFrame, caches: Caches, site: Site = Site(), url: str = "url", host: str | None = None) -> DataFrame:
    """links with path, kind, verdict, evidence, confidence, redirects_to, suggestion.

    Verdicts are valid, broken, moved and unverifiable, such as what is no page of
    the site (kind other).  Every link is one row, repeats included; columns of these names that
    links has already are replaced.
    """
    taken = [c for c in ("path", "kind", "verdict", "evidence", "confidence", "redirects_to", "suggestion") if c in links.columns and c != "path"]
    rows = links.drop(*taken).withColumn("path", canonical_path(url, host)).withColumn("_parent", parent_path("path"))
    listed = _listed(caches)
    tasks = tasks_for(links, *([] if listed is None else [listed]))
    facts = known_paths(caches, tasks)
    own = [f for _, _, f, _ in FACTS] + ["_served", "_units", "_types", "_to"]
    if facts is None:
        rows = rows.withColumns({c: F.lit(None).cast("array<string>" if c in ("_units", "_types") else "string" if c == "_to" else "boolean") for c in own})
        rows = rows.withColumns({"_p_module": F.lit(None).cast("boolean"), "_p_tomb": F.lit(None).cast("boolean"), "_p_outside": F.lit(None).cast("boolean"), "_lost": F.lit(None).cast("boolean"), "_p_units": F.lit(None).cast("array<string>")})
    else:
        above = facts.where("_module or _tomb or _outside").select(F.col("_k").alias("_pk"), F.col("_module").alias("_p_module"), F.col("_tomb").alias("_p_tomb"), F.col("_outside").alias("_p_outside"), F.col("_served").alias("_lost"), F.col("_units").alias("_p_units"))
        rows = dealt(rows, tasks, "path").join(facts, F.col("path") == F.col("_k"), "left").drop("_k")
        # a parent that is no deeper or higher than modules has no entry: links below it, such as all modules, keep apart
        depth = F.size(F.split("_k", "/"))
        depths = [r.d for r in listed.where("_module or _tomb or _outside").select(depth.alias("d")).distinct().collect()]
        rows = rows.withColumn("_at", F.when(F.size(F.split("_parent", "/")).isin(depths), F.col("_parent")).otherwise(F.concat(F.lit(" "), "path")))
        rows = dealt(rows, tasks, "_at").join(dealt(above, tasks, "_pk"), F.col("_at") == F.col("_pk"), "left").drop("_pk", "_at")
    is_module, is_unit = F.coalesce("_module", F.lit(False)), F.coalesce("_p_module", F.lit(False))
    rows = rows.withColumn("kind", F.coalesce(F.when(F.col("path").isNotNull(), classify_known("path", is_module, is_unit)), F.lit("other")))
    below = F.col("kind") == "unit"
    types = F.element_at(F.create_map(*[x for k, t in CONTENT.items() for x in (F.lit(k), F.lit(t))]), F.col("kind"))
    rows = rows.withColumns({"_tomb": F.when(below, F.col("_p_tomb")).otherwise(F.col("_tomb")), "_outside": F.when(below, F.col("_p_outside")).otherwise(F.col("_outside")), "_content": F.array_contains("_types", types), "_units": F.col("_p_units")})

    kind, scope = F.col("kind"), scope_for("path", site.learn, site.index)
    s = lambda verdict, evidence, confidence="high": F.struct(F.lit(verdict).alias("verdict"), F.lit(evidence).alias("evidence"), F.lit(confidence).alias("confidence"))
    missing = s("unverifiable", "missing-data")
    module = F.when(F.lit(caches.modules is None), missing).when(F.col("_module") & F.coalesce(F.col("_served").cast("boolean"), F.lit(False)), s("broken", "learn-catalog")).when(F.col("_module"), s("valid", "learn-catalog")).when(F.col("_tomb"), s("broken", "tombstone")).when(F.col("_outside"), s("valid", "out-of-scope")).otherwise(s("broken", "learn-catalog"))
    listed = F.array_contains("_units", F.col("path")) if caches.modules is not None else F.lit(False)
    no_list, lost = F.col("_units").isNull(), F.coalesce(F.col("_lost").cast("boolean"), F.lit(False))
    unit = (
        F.when(F.lit(caches.modules is None), missing)
        .when(~is_unit & F.coalesce("_tomb", F.lit(False)), s("broken", "tombstone"))
        .when(~is_unit & F.coalesce("_outside", F.lit(False)), s("unverifiable", "out-of-scope"))
        .when(~is_unit, s("broken", "learn-catalog"))
        .when(lost, s("broken", "learn-catalog"))
        .when(no_list, s("unverifiable", "learn-catalog"))
        .when(listed, s("valid", "learn-catalog"))
        .otherwise(s("broken", "learn-catalog"))
    )
    content = F.when(F.lit(caches.content is None), missing).when(F.col("_content"), s("valid", "learn-content")).when(F.col("_content_tomb"), s("broken", "tombstone")).when(kind.isin(*PARTIAL), s("unverifiable", "learn-content")).otherwise(s("broken", "learn-content"))
    docs = F.when(F.lit(caches.index is None), missing).when(F.col("_indexed"), s("valid", "docs-urls")).when(F.col("_redirect"), s("moved", "docs-redirects")).when(F.col("_held"), s("broken", "quarantine")).when(scope.isNull() | (scope == "excluded"), s("unverifiable", "scope")).otherwise(s("broken", "docs-urls", "low"))
    verdict = F.when(F.col("path").isNull(), s("unverifiable", "scope")).when(kind == "module", module).when(kind == "unit", unit).when(kind.isin(*CONTENT), content).when(kind == "other", s("unverifiable", "scope")).otherwise(docs)
    rows = rows.withColumn("_v", verdict)
    rows = rows.select("*", *[F.col(f"_v.{c}").alias(c) for c in ("verdict", "evidence", "confidence")])
    moved = F.col("evidence") == "docs-redirects"
    rows = rows.withColumn("redirects_to", F.when(moved, F.col("_to"))).withColumn("suggestion", F.when(moved & F.col("_to").isNotNull(), absolute("_to", site.host)))
    if caches.modules is not None:
        dead = rows.where((kind == "unit") & (F.col("verdict") == "broken") & is_unit & ~no_list & ~lost).select(F.col("_parent").alias("module"), last_segment("path").alias("dead"))
        lists = caches.modules.select(F.col("path").alias("module"), F.posexplode("unitUrls").alias("pos", "path"))
        near = suggest_slug(dealt(dead, tasks, "module"), dealt(lists, tasks, "module"), "module").select(F.col("module").alias("_m"), F.col("dead").alias("_d"), F.col("suggestion").alias("_s"))
        rows = rows.withColumn("_slug", last_segment("path"))
        rows = dealt(rows, tasks, "_parent", "_slug").join(dealt(near, tasks, "_m", "_d"), (kind == "unit") & (F.col("verdict") == "broken") & ~lost & (F.col("_parent") == F.col("_m")) & (F.col("_slug") == F.col("_d")), "left")
        rows = rows.withColumn("suggestion", F.coalesce("suggestion", absolute("_s", site.host)))
    made = ("path", "kind", "verdict", "evidence", "confidence", "redirects_to", "suggestion")
    return rows.select(*[c for c in links.columns if c not in made], *made)


def enriched(results: DataFrame, ledger: DataFrame, site: Site = Site()) -> DataFrame:
    """Broken and moved rows with the ledger's `change`; a sure one fills an empty redirect, and, for a move, an empty suggestion."""
    doubtful = results.where(F.col("verdict").isin("broken", "moved"))
    hit = lookup_changes(doubtful, ledger).select(F.col("link").alias("_l"), F.struct("state", "outcome", "confidence", "match", "entry_path", "final_path", "to", "chain", "cycle", "truncated").alias("change"))
    out = results.join(hit, (F.col("path") == F.col("_l")) & F.col("verdict").isin("broken", "moved"), "left").drop("_l")
    sure = (F.col("change.confidence") == "high") & F.col("change.to").isNotNull()
    return out.withColumns(
        {
            "suggestion": F.coalesce("suggestion", F.when(sure & (F.col("change.state") == "moved"), absolute("change.to", site.host))),
            "redirects_to": F.coalesce("redirects_to", F.when(sure, F.col("change.to"))),
        }
    )


def with_live(results: DataFrame, probes: DataFrame, unverifiable_too: bool = True) -> DataFrame:
    """results under a live check: probes (path, live_verdict, live_to).

    A healthy page is valid, a lost one broken, a moved one moved; no answer
    leaves the cached verdict.  A valid row has no recorded change any more.
    """
    out = results.join(probes.select("path", "live_verdict", "live_to").dropDuplicates(["path"]), "path", "left")
    asked = F.col("verdict").isin("broken", "moved") | (F.lit(unverifiable_too) & (F.col("verdict") == "unverifiable"))
    told = asked & F.col("live_verdict").isin("ok", "broken", "moved")
    verdict = F.when(told, F.when(F.col("live_verdict") == "ok", "valid").otherwise(F.col("live_verdict"))).otherwise(F.col("verdict"))
    out = out.withColumns(
        {
            "evidence": F.when(told, "live").otherwise(F.col("evidence")),
            "confidence": F.when(told, "high").otherwise(F.col("confidence")),
            "redirects_to": F.when(told, F.col("live_to")).otherwise(F.col("redirects_to")),
            "suggestion": F.when(told & (F.col("live_verdict") == "ok"), F.lit(None).cast("string")).otherwise(F.col("suggestion")),
            "verdict": verdict,
        }
    )
    out = out.withColumn("change", F.when(F.col("verdict") != "valid", F.col("change"))) if "change" in out.columns else out
    return out.drop("live_verdict", "live_to")


def verdict_summary(results: DataFrame) -> DataFrame:
    """kind, verdict, n: all, by verdict and by kind and verdict (null: all)."""
    return results.groupingSets([[], ["verdict"], ["kind", "verdict"]], "kind", "verdict").agg(F.count("*").alias("n")).select("kind", "verdict", "n")


def out_of_scope_segments(results: DataFrame) -> DataFrame:
    return results.where("evidence = 'scope' and kind = 'docs'").groupBy(first_segment("path").alias("segment")).agg(F.count("*").alias("n"))
