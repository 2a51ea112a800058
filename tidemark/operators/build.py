"""Catalogue building: taxonomy, modules, units, content lists, signatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import exam_code_of_uid
from ..functions.scalars import sha1_lines
from ..sources.shared import dealt, tasks_for


def flatten_taxonomy(entries: DataFrame) -> DataFrame:
    """id, name, top: a two-level tree (id, name, children) as rows; a top entry is its own top."""
    tops = entries.select("id", "name", F.col("id").alias("top"))
    below = entries.select(F.col("id").alias("top"), F.explode("children").alias("c")).select("c.id", "c.name", "top")
    return tops.unionByName(below.join(tops.select("id"), "id", "left_anti"))


def with_custom(taxonomy: DataFrame, custom: DataFrame) -> DataFrame:
    """Custom ids are added, and never replace an entry."""
    return taxonomy.unionByName(custom.select(taxonomy.columns).join(taxonomy.select("id"), "id", "left_anti"))


def categories(modules: DataFrame, taxonomy: DataFrame, column: str) -> DataFrame:
    """uid, tops, names: sorted top ids, and names, of a module's ids; unknown ids are left out of tops and stand as names."""
    rows = modules.select("uid", F.explode_outer(column).alias("id")).join(taxonomy, "id", "left")
    return rows.groupBy("uid").agg(F.array_sort(F.collect_set("top")).alias("tops"), F.array_sort(F.collect_set(F.coalesce(F.nullif("name", F.lit("")), "id"))).alias("names"))


def split_scope(modules: DataFrame, tops: DataFrame, allowed: list[str], excluded: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Modules with an allowed and no excluded top category, and the others."""
    t = tops.select("uid", F.exists("tops", lambda x: x.isin(*allowed)).alias("_in"), (F.exists("tops", lambda x: x.isin(*excluded)) if excluded else F.lit(False)).alias("_out"))
    rows = modules.join(t, "uid", "left")
    good = F.coalesce(F.col("_in") & ~F.col("_out"), F.lit(False))
    return rows.where(good).drop("_in", "_out"), rows.where(~good).drop("_in", "_out")


def unit_signature(modules: DataFrame, units: DataFrame, uid: str = "uid", unit_ids: str = "units", modified: str = "lastModified", unit: str = "uid", unit_modified: str = "lastModified") -> DataFrame:
    """uid, unitSig: sha1 of the module's stamp and its units' ids and stamps, in order."""
    one = modules.select(F.col(uid).alias("uid"), F.posexplode(unit_ids).alias("pos", "_u")).join(units.select(F.col(unit).alias("_u"), F.col(unit_modified).alias("_m")), "_u", "left")
    lines = one.groupBy("uid").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.concat_ws(":", "_u", F.coalesce("_m", F.lit(""))).alias("t")))), lambda x: x.t).alias("_t"))
    out = modules.select(F.col(uid).alias("uid"), F.coalesce(modified, F.lit("")).alias("_m")).join(lines, "uid", "left")
    return out.select("uid", sha1_lines(F.col("_m"), F.coalesce("_t", F.array().cast("array<string>"))).alias("unitSig"))


def exam_codes(certifications: DataFrame, exams: DataFrame) -> DataFrame:
    """uid, exams: sorted distinct codes of the exams a certification names, taken from the uid where there is no exam."""
    rows = certifications.select("uid", F.explode("exams").alias("exam")).join(exams.select(F.col("uid").alias("exam"), "code"), "exam", "left")
    codes = rows.groupBy("uid").agg(F.array_sort(F.collect_set(F.coalesce("code", exam_code_of_uid("exam")))).alias("exams"))
    return certifications.select("uid").join(codes, "uid", "left").select("uid", F.coalesce("exams", F.array().cast("array<string>")).alias("exams"))


def apply_guide_probes(items: DataFrame, previous: DataFrame, probes: DataFrame) -> DataFrame:
    """items with studyGuide and guideKnown: set when verified, cleared when absent, kept from before when the answer tells nothing.

    previous (uid, studyGuide), probes (uid, path, outcome).
    """
    rows = items.join(previous.select("uid", F.col("studyGuide").alias("_old")), "uid", "left").join(probes.select("uid", F.col("path").alias("_new"), F.col("outcome").alias("_o")), "uid", "left")
    guide = F.when(F.col("_o") == "verified", F.col("_new")).when(F.col("_o").isin("absent", "redirected"), F.lit(None)).otherwise(F.col("_old"))
    return rows.withColumn("studyGuide", guide).withColumn("guideKnown", F.coalesce(F.col("_o").isin("verified", "absent", "redirected"), F.lit(False))).drop("_old", "_new", "_o")


def plan_refresh(modules: DataFrame, previous: DataFrame, full: bool = False) -> DataFrame:
    """uid, reason (null: reuse): which modules' units to read again."""
    from .classify import refresh_reason

    old = previous.select("uid", F.col("unitSig").alias("_sig"), F.col("unitUrls").alias("_urls"), F.col("path").alias("_path"))
    rows = modules.join(old, "uid", "left")
    below: Column = F.forall("_urls", lambda u: u.startswith(F.concat(F.col("path"), F.lit("/"))))
    reason = refresh_reason(F.col("_path").isNull(), F.col("_urls").isNotNull(), F.col("_sig").eqNullSafe(F.col("unitSig")), F.coalesce(F.size("_urls") == F.size("units"), F.lit(False)) & F.coalesce(below, F.lit(False)), F.coalesce(F.get("_urls", F.lit(0)).eqNullSafe(F.col("firstUnitPath")), F.lit(False)))
    return rows.select("uid", F.coalesce(reason, F.when(F.lit(full), "full")).alias("reason"))


def resolve_units(modules: DataFrame, plan: DataFrame, previous: DataFrame, fetched: DataFrame) -> DataFrame:
    """uid, unitUrls, hierarchyNotFound: fetched, reused, or carried forward where the fetch failed and the units are the same."""
    rows = modules.select("uid", "units", "unitSig").join(plan, "uid", "left").join(previous.select("uid", F.col("unitUrls").alias("_old"), F.col("unitSig").alias("_sig")), "uid", "left").join(fetched.select("uid", F.col("outcome").alias("_o"), F.col("urls").alias("_new")), "uid", "left")
    same = F.coalesce((F.size("_old") == F.size("units")) & (F.col("_sig") == F.col("unitSig")), F.lit(False))
    urls = F.when(F.col("reason").isNull(), F.col("_old")).when(F.col("_o") == "ok", F.col("_new")).when(F.col("_o") == "not-found", F.lit(None)).when(same, F.col("_old"))
    return rows.select("uid", urls.alias("unitUrls"), F.when(F.col("_o") == "not-found", True).alias("hierarchyNotFound"))


def update_families(memo: DataFrame, families: DataFrame, outcomes: DataFrame, signature: str, today: str) -> DataFrame:
    """The sitemap memo after a run: families found relevant or not; failed downloads never make one irrelevant."""
    rows = families.select("family").distinct().join(memo, "family", "left").join(outcomes.select("family", F.col("rows").alias("_n"), F.col("failed").alias("_f")), "family", "left")
    told = F.col("_n").isNotNull() & ~((F.col("_n") == 0) & F.coalesce("_f", F.lit(False)))
    return rows.select("family", F.when(told, F.col("_n") > 0).otherwise(F.col("relevant")).alias("relevant"), F.when(told, F.lit(today)).otherwise(F.col("checked")).alias("checked"), F.when(told, F.lit(signature)).otherwise(F.col("scope")).alias("scope"))


def apply_decisions(links: DataFrame, decisions: DataFrame, today: str) -> DataFrame:
    """Links (module, pos, path, url) after their decisions: dropped, rewritten (was = old path), kept or flagged; one row per module and target.

    decisions (path, decision, to); without one a link stays as it is.
    """
    from .dedupe import first_per

    tasks = tasks_for(links)
    rows = dealt(links, tasks, "path").join(dealt(decisions.select("path", "decision", F.col("to").alias("_to")), tasks, "path"), "path", "left").where("decision is null or decision <> 'drop'")
    rewritten = F.col("decision").eqNullSafe("rewrite") & F.col("_to").isNotNull()
    rows = rows.select("module", "pos", F.when(rewritten, F.col("_to")).otherwise(F.col("path")).alias("path"), F.when(rewritten, F.col("path")).alias("was"), F.when(F.col("decision").isin("keep", "rewrite"), F.lit(today)).alias("checked"), (F.col("decision").eqNullSafe("unverified")).alias("unverified"))
    return first_per(dealt(rows, tasks, "module", "path"), ["module", "path"], [F.asc("pos")])
