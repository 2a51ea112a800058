"""Prefix joins, the ledger chase, three-valued membership, ordered lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MAX_HOPS
from ..functions.paths import ancestors, last_segment, parent_path, slug_text
from ..sources.shared import settled
from .dedupe import first_per


def prefix_join(paths: DataFrame, prefixes: DataFrame, path: str = "path", prefix: str = "prefix", itself: bool = True) -> DataFrame:
    """Rows of paths with every row of prefixes that is an ancestor.

    An equi-join on the exploded ancestors: rows grow with path depth, where a
    startswith() join would compare everything with everything.
    """
    return paths.withColumn("_a", F.explode(ancestors(path, itself))).join(prefixes, F.col("_a") == prefixes[prefix]).drop("_a")


def longest_prefix(paths: DataFrame, prefixes: DataFrame, key: str, path: str = "path", prefix: str = "prefix", itself: bool = True) -> DataFrame:
    """key, prefix: the longest prefix that holds each path; paths without one are left out."""
    hit = prefix_join(paths.select(key, path), prefixes.select(prefix).distinct(), path, prefix, itself)
    best = F.max(F.struct(F.length(prefix).alias("n"), F.col(prefix).alias("p")))
    return hit.groupBy(key).agg(best.alias("_b")).select(key, F.col("_b.p").alias(prefix))


def has_ancestor_in(paths: DataFrame, holders: DataFrame, path: str = "path", holder: str = "path", itself: bool = False) -> DataFrame:
    """Rows of paths below some path of holders."""
    found = prefix_join(paths.select(path).distinct(), holders.select(F.col(holder).alias("_h")).distinct(), path, "_h", itself)
    return paths.join(found.select(path).distinct(), path, "left_semi")


def paths_below(paths: DataFrame, holders: DataFrame) -> DataFrame:
    """path: the different paths below some path of holders.

    Only prefixes as deep as holders are joined, which are a few numbers: those
    next to the root begin all paths, and would meet in one task.
    """
    h = holders.select(F.col("path").alias("_h")).distinct()
    depths = sorted(r.d for r in h.select(F.size(F.split("_h", "/")).alias("d")).distinct().collect())
    parts = F.split("path", "/")
    above = F.filter(F.array(*[F.when(F.size(parts) > d, F.array_join(F.slice(parts, 1, d), "/")) for d in depths or [2]]), lambda a: a.isNotNull())
    return paths.select("path", F.explode(above).alias("_a")).join(h, F.col("_a") == F.col("_h"), "left_semi").select("path").distinct()


def index_changes(changes: DataFrame) -> DataFrame:
    """One entry per path: the most recently verified; of equals the one in 'removed'."""
    return first_per(changes, ["path"], [F.desc(F.coalesce("lastVerified", F.lit(""))), F.when(F.col("file") == "removed", 0).otherwise(1)])


def module_depths(index: DataFrame) -> list[int]:
    """The depths at which entries of kind module stand, deepest first: few, whatever the ledger's size."""
    rows = index.where("kind = 'module'").select((F.size(F.split("path", "/")) - 1).alias("d")).distinct().collect()
    return sorted((r.d for r in rows), reverse=True)


def resolve(links: DataFrame, index: DataFrame, at: str, depths: list[int]) -> DataFrame:
    """links with the entry of path `at` (columns r_*): the exact one, else the nearest ancestor of kind module.

    r_match is exact or ancestor, r_rest the path below an ancestor; without an
    entry all are null.  An equi-join for the path itself and one for each depth
    of modules: no link becomes several rows.
    """
    names = ("path", "file", "outcome", "to")
    entry = lambda rows, p: rows.select(*[F.col(c).alias(f"{p}_{c}") for c in names])
    out = links.join(entry(index, "_x"), F.col(at) == F.col("_x_path"), "left")
    modules, found = index.where("kind = 'module'"), ["_x"]
    for d in depths:
        p, parts = f"_m{d}", F.split(F.col(at), "/")
        above = F.when(F.col("_x_path").isNull() & (F.size(parts) - 1 > d), F.array_join(F.slice(parts, 1, d + 1), "/")).otherwise(F.concat(F.lit(" "), F.col(at)))
        out = out.withColumn("_a", above).join(entry(modules, p), F.col("_a") == F.col(f"{p}_path"), "left").drop("_a")
        found.append(p)
    picked = F.coalesce(*[F.when(F.col(f"{p}_path").isNotNull(), F.struct(*[F.col(f"{p}_{c}").alias(c) for c in names])) for p in found])
    out = out.withColumn("_e", picked).drop(*[f"{p}_{c}" for p in found for c in names])
    out = out.select("*", *[F.col(f"_e.{c}").alias(f"r_{c}") for c in names]).drop("_e")
    exact = F.col("r_path") == F.col(at)
    return out.withColumn("r_match", F.when(exact, "exact").when(F.col("r_path").isNotNull(), "ancestor")).withColumn("r_rest", F.when(exact, "").otherwise(F.expr(f"substring({at}, length(r_path) + 1)")))


def lookup_changes(links: DataFrame, changes: DataFrame, link: str = "path") -> DataFrame:
    """What the ledger says about each link: a row per different link with a record.

    link, state (removed, moved), outcome, confidence, match, entry_path,
    final_path, to, chain, cycle, truncated.  A moved destination is followed
    through the ledger, MAX_HOPS times at most and never in a circle; an
    ancestor of kind module covers what lies below it, with low confidence for
    moves.  No row means that no change is recorded, not that the link is good.

    A recursive query cannot pick the nearest ancestor inside its loop, so there
    is a round a hop; each goes on with the links that are still under way, kept
    in the shared folder.  The links as a whole are exchanged for the first
    round alone: by themselves, and once for each depth of modules.
    """
    index = settled(index_changes(changes))
    depths = module_depths(index)
    none = F.lit(None).cast("string")
    now = links.select(F.col(link).alias("link")).where(F.col("link").isNotNull() & (F.col("link") != "/")).distinct()
    now = now.select("link", F.col("link").alias("cur"), F.array("link").alias("chain"), F.lit("high").alias("conf"), none.alias("match"), none.alias("entry_path"), none.alias("outcome"), none.alias("final_path"))
    ended = []
    for hops in range(MAX_HOPS + 1):
        r = resolve(now, index, "cur", depths)
        unknown, from_here = F.col("r_path").isNull(), F.col("r_file") == "moved"
        if not hops:
            r = r.where(~unknown)
        low = F.col("r_outcome").eqNullSafe("unverified") | (F.col("r_match").eqNullSafe("ancestor") & from_here)
        dest = F.when(from_here & F.col("r_to").isNotNull(), F.concat("r_to", "r_rest"))
        r = r.withColumns({"conf": F.when(~unknown & low, "low").otherwise(F.col("conf")), "dest": dest})
        cycle = F.array_contains("chain", F.col("dest"))
        end = F.when(unknown, "moved").when(F.col("r_file") == "removed", "removed").when(F.col("r_to").isNull(), "off-site").when(cycle, "cycle").when(F.lit(hops >= MAX_HOPS), "truncated")
        r = r.withColumns(
            {
                "end": end,
                "match": F.coalesce("match", "r_match"),
                "entry_path": F.coalesce("entry_path", "r_path"),
                "outcome": F.coalesce("r_outcome", "outcome"),
                "final_path": F.coalesce("r_path", "final_path"),
            }
        )
        r = settled(r.select("link", "chain", "conf", "match", "entry_path", "outcome", "final_path", "end", "dest", "r_match", "r_to"))
        ended.append(r.where("end is not null"))
        now = r.where("end is null").select("link", F.col("dest").alias("cur"), F.concat("chain", F.array("dest")).alias("chain"), "conf", "match", "entry_path", "outcome", "final_path")
        if now.isEmpty():
            break
    out = reduce(DataFrame.unionByName, ended)
    to = F.when(F.col("end") == "removed", F.when(F.col("r_match") == "exact", F.col("r_to"))).when(F.col("end").isin("moved", "truncated"), F.element_at("chain", -1)).when(F.col("end") == "cycle", F.col("dest"))
    sure = F.when(F.col("end").isin("cycle", "truncated"), "low").otherwise(F.col("conf"))
    state = F.when(F.col("end") == "removed", "removed").otherwise("moved")
    return out.select("link", state.alias("state"), "outcome", sure.alias("confidence"), "match", "entry_path", "final_path", to.alias("to"), "chain", (F.col("end") == "cycle").alias("cycle"), (F.col("end") == "truncated").alias("truncated"))


def membership3(paths: DataFrame, sets: list[tuple[DataFrame, bool]], complete: Column, path: str = "path") -> DataFrame:
    """paths with is_live: true or false by the first set (of paths) that holds it, false where all are complete, else unknown."""
    out, decided = paths, F.lit(None).cast("boolean")
    for i, (s, value) in enumerate(sets):
        flag = f"_m{i}"
        out = out.join(s.select(F.col(s.columns[0]).alias(path)).distinct().withColumn(flag, F.lit(True)), path, "left")
        decided = F.coalesce(decided, F.when(F.col(flag), F.lit(value)))
    out = out.withColumn("is_live", F.coalesce(decided, F.when(complete, F.lit(False))))
    return out.drop(*[f"_m{i}" for i in range(len(sets))])


def with_parent(paths: DataFrame, members: DataFrame, path: str = "path") -> DataFrame:
    """paths with is_member and is_child: the path, or its parent, is in members."""
    m = members.select(F.col(members.columns[0]).alias("_m")).distinct()
    out = paths.withColumn("_p", parent_path(path))
    out = out.join(m.withColumn("is_member", F.lit(True)), F.col(path) == F.col("_m"), "left").drop("_m")
    out = out.join(m.withColumn("is_child", F.lit(True)), F.col("_p") == F.col("_m"), "left").drop("_m", "_p")
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("is_member", "is_child")})


def suggest_slug(dead: DataFrame, lists: DataFrame, key: str) -> DataFrame:
    """key, dead, suggestion: of the key's paths (key, pos, path) the first with the dead slug, then with its text, then with an ending in common."""
    slug, text = last_segment("path"), slug_text(last_segment("path"))
    want = slug_text(F.col("dead"))
    rank = F.when(slug == F.col("dead"), 1).when(text == want, 2).when(slug.endswith(want) | want.endswith(text), 3)
    hit = dead.select(key, "dead").distinct().join(lists.select(key, "pos", "path"), key).withColumn("rank", rank).where("rank is not null")
    return hit.groupBy(key, "dead").agg(F.min_by("path", F.struct("rank", "pos")).alias("suggestion"))


def ordered_lookup(rows: DataFrame, key: str, ids: str, names: DataFrame, id_: str, name: str, fallback: bool = False) -> DataFrame:
    """key, names (array in the order of ids), unresolved: ids without a name are left out, or stand for themselves."""
    one = rows.select(key, F.posexplode(ids).alias("pos", id_)).join(names.select(id_, F.nullif(F.col(name), F.lit("")).alias("_n")), id_, "left")
    value = F.coalesce("_n", id_) if fallback else F.col("_n")
    agg = one.groupBy(key).agg(F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct("pos", value.alias("n"))))).alias("l"), F.count_if(F.col("_n").isNull()).alias("unresolved"))
    out = rows.select(key).join(agg, key, "left")
    return out.select(key, F.coalesce(F.transform("l", lambda x: x.n), F.array().cast("array<string>")).alias("names"), F.coalesce("unresolved", F.lit(0)).alias("unresolved"))


def siblings(groups: DataFrame, group: str = "group_id", page: str = "page", pos: str = "pos") -> DataFrame:
    """page, sibling, pos: the other pages of a page's groups, the first place of each, in sidebar order."""
    a = groups.select(group, F.col(page).alias("page"))
    b = groups.select(group, F.col(page).alias("sibling"), F.col(pos).alias("pos"))
    both = a.join(b, group).where("page <> sibling")
    return both.groupBy("page", "sibling").agg(F.min(F.struct(group, "pos")).alias("_p")).select("page", "sibling", F.col(f"_p.{group}").alias(group), F.col("_p.pos").alias("pos"))


def scope_modules(courses: DataFrame, guides: DataFrame, paths: DataFrame, direct: DataFrame, modules: DataFrame) -> DataFrame:
    """Distinct module paths of courses (course, refs): a ref is a learning path (uid, modules) or a module uid, plus direct ones."""
    refs = courses.select(F.explode("refs").alias("uid")).union(guides.select(F.explode("refs").alias("uid"))).distinct()
    of_paths = refs.join(paths, "uid").select(F.explode("modules").alias("uid"))
    uids = refs.union(of_paths).union(direct.select("uid")).distinct()
    return uids.join(modules.select("uid", "path"), "uid").select("path").distinct()
