"""The documentation index: what a sitemap pass plans for each path, and what its answers change.

A path is known from the sitemap, the catalogue, the previous index or the
quarantine.  plan() gives each one action, reconcile() one result; both are a
few joins on path, whatever the number of sources that know it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Site
from ..functions.paths import scope_class
from .dedupe import fold_quarantine, pick_record

#: Actions that fetch a page, look again at a listed one, ask for one that is no longer listed.
FETCH, VERIFY, MISSING = ("new", "changed"), ("kept", "bootstrapped"), ("missing",)
#: The lastmod of a record that came back from quarantine: it differs from any listed one, so that the page is read again.
RELEASED = "released"
RECORD = ("url", "title", "lastmod", "checked")


def _column(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def fold_catalogue(catalogue: DataFrame, rows: DataFrame, site: Site = Site()) -> DataFrame:
    """One record per path of the read scope: url, title, lastmod, checked, stamped.

    Of several records the sitemap's spelling wins, then a title, a lastmod, the
    latest check.  stamped: whether the record has a lastmod of its own, null
    or not; without such a column, whether it is not null.
    """
    known = catalogue.where(scope_class("path", site.learn, site.index).eqNullSafe("learn"))
    known = known.select("path", *[_column(known, c).alias(c) for c in RECORD], F.coalesce(_column(known, "stamped", "boolean"), _column(known, "lastmod").isNotNull()).alias("stamped"))
    listed = rows.select("path", F.col("url").alias("_row"))
    return pick_record(known.join(listed, "path", "left"), "path", "_row").drop("_row")


def plan(rows: DataFrame, catalogue: DataFrame, previous_index: DataFrame, quarantine: DataFrame, redirects: DataFrame | None = None, today: str = "", site: Site = Site(), recheck_days: int = 30, sitemap_ok: bool = True) -> DataFrame:
    """path, action, reason, url, lastmod, prev_*: one row per known path.

    rows (path, url, lastmod): one per path; catalogue (path, url, title,
    lastmod, checked); previous_index (path, lastmod); quarantine (path, url,
    title, status, firstDetected, lastChecked); redirects (from, lastSeen).

    quarantined   is asked again, and not read meanwhile
    index-only    listed, in the scope that has no records
    redirecting   listed, no record, and seen redirecting fewer than recheck_days ago; not so if it was absent from the previous index
    new, changed  to be read; changed: untitled, or another lastmod
    bootstrapped  the record takes the listed lastmod over; kept: nothing to do
    missing       no longer listed; carried where a sitemap file failed, for any path may be in it
    out-of-scope  known, and in no scope any more
    """
    spark = rows.sparkSession
    redirects = spark.createDataFrame([], "`from` string, lastSeen string") if redirects is None else redirects
    s = rows.select("path", F.col("url").alias("s_url"), F.col("lastmod").alias("s_mod"), F.lit(True).alias("s"))
    c = fold_catalogue(catalogue, rows, site).select("path", *[F.col(x).alias(f"prev_{x}") for x in RECORD], F.col("stamped").alias("c_stamped"), F.lit(True).alias("c"))
    i = previous_index.select("path", _column(previous_index, "lastmod").alias("i_mod"), F.lit(True).alias("i"))
    q = fold_quarantine(quarantine).select("path", *[F.col(x).alias(f"q_{x}") for x in ("url", "title", "status", "firstDetected", "lastChecked")], F.lit(True).alias("q"))
    fresh = redirects.where(F.datediff(F.lit(today).cast("date"), F.col("lastSeen").cast("date")) < recheck_days).select(F.col("from").alias("path"), F.lit(True).alias("r")).distinct() if today else redirects.limit(0).select(F.col("from").alias("path"), F.lit(True).alias("r"))
    known = s.join(c, "path", "full").join(i, "path", "full").join(q, "path", "full").join(fresh, "path", "left")
    baseline = not previous_index.isEmpty()
    cls = scope_class("path", site.learn, site.index)
    listed, has = _flag("s"), _flag("c")
    still = F.lit(not baseline) | _flag("i")
    untitled = has & (F.coalesce("prev_title", F.lit("")) == "")
    action = (
        F.when(_flag("q"), "quarantined")
        .when(listed & ~cls.eqNullSafe("learn"), F.when(cls.isNull(), "out-of-scope").otherwise("index-only"))
        .when(listed & ~has & _flag("r") & still, "redirecting")
        .when(listed & ~has, "new")
        .when(listed & untitled, "changed")
        .when(listed & ~_flag("c_stamped"), "bootstrapped")
        .when(listed & ~F.col("prev_lastmod").eqNullSafe(F.col("s_mod")), "changed")
        .when(listed, "kept")
        .when(cls.isNull(), "out-of-scope")
        .otherwise("missing" if sitemap_ok else "carried")
    )
    out = known.withColumn("action", action).withColumn("listed", listed).withColumn("has_record", has).withColumn("in_previous", _flag("i"))
    reason = F.when(F.col("action") == "changed", F.when(untitled, "untitled").otherwise("lastmod"))
    carried = F.coalesce("i_mod", F.when(F.col("prev_lastmod") != RELEASED, F.col("prev_lastmod")))
    lastmod = F.when(listed, F.col("s_mod")).otherwise(carried)
    return out.select("path", "action", reason.alias("reason"), F.coalesce("s_url", "prev_url", "q_url").alias("url"), lastmod.alias("lastmod"), "listed", "has_record", "in_previous", *[f"prev_{x}" for x in RECORD], *[f"q_{x}" for x in ("title", "status", "firstDetected", "lastChecked")])


def reconcile(planned: DataFrame, results: DataFrame, today: str, site: Site = Site()) -> DataFrame:
    """What a run makes of each planned path.

    results (path, outcome, status, to, title, noindex): answers of the queues;
    title and noindex of pages that were read.  No answer, or a transient one,
    changes nothing.  The columns:

    state       how the answer was taken
    in_index, index_lastmod
    in_catalogue, url, title, lastmod, checked (and read: the title is new)
    quarantined, status, firstDetected, lastChecked
    contradicted  the path answered for itself, so an old redirect of it is stale
    moved_to      of state 'moved': the destination (null: off the site), with status
    """
    r = results.select("path", F.col("outcome").alias("o"), _column(results, "status", "int").alias("r_status"), _column(results, "to").alias("r_to"), _column(results, "title").alias("r_title"), F.coalesce(_column(results, "noindex", "boolean"), F.lit(False)).alias("r_noindex"))
    x = planned.join(r, "path", "left")
    a, o = F.col("action"), F.coalesce("o", F.lit("none"))
    read, seen, lost, held = a.isin(*FETCH), a.isin(*VERIFY), a.isin(*MISSING), a == "quarantined"
    asked = read | seen | lost | held
    titled = F.coalesce("r_title", F.lit("")) != ""
    had_title = F.coalesce("prev_title", F.lit("")) != ""
    state = (
        F.when(~asked | ~o.isin("live", "gone", "moved"), F.when(asked & (o != "none"), "transient").otherwise("untouched"))
        .when(o == "moved", "moved")
        .when((o == "gone") & held, "still-gone")
        .when((o == "gone") & read & ~F.col("has_record"), "not-yet-there")
        .when(o == "gone", "quarantined")
        .when(held, "released")
        .when(read & F.col("r_noindex"), "noindex")
        .when(read & titled, "read")
        .when(read & had_title, "kept-title")
        .when(read, "untitled")
        .otherwise("confirmed")
    )
    x = x.withColumn("state", state)
    st = F.col("state")
    q = (held & ~st.isin("released", "moved")) | (st == "quarantined")
    cls = scope_class("path", site.learn, site.index)
    stays = F.col("listed") | a.isin("missing", "carried") & ~st.isin("moved", "quarantined") | (st == "released")
    in_index = stays & ~q & cls.isNotNull()
    released = (st == "released") & (F.coalesce("q_title", F.lit("")) != "")
    record = F.when(st.isin("noindex", "untitled", "quarantined"), False).when((st == "moved") & ~held, False).when((st == "read") | released, True).otherwise(F.col("has_record"))
    in_catalogue = record & ~q & cls.eqNullSafe("learn")
    adopts = a == "bootstrapped"
    lastmod = F.when(st == "read", F.col("lastmod")).when(released, RELEASED).when(adopts, F.col("lastmod")).otherwise(F.col("prev_lastmod"))
    checked = F.when(st.isin("read", "confirmed") | released, F.lit(today)).otherwise(F.col("prev_checked"))
    title = F.when(st == "read", F.col("r_title")).when(released, F.col("q_title")).otherwise(F.coalesce("prev_title", "q_title"))
    again = st == "still-gone"
    return x.select(
        "path",
        "action",
        "state",
        in_index.alias("in_index"),
        F.when(in_index, F.when((st == "released") & ~F.col("listed"), None).otherwise(F.col("lastmod"))).alias("index_lastmod"),
        in_catalogue.alias("in_catalogue"),
        "url",
        title.alias("title"),
        lastmod.alias("lastmod"),
        checked.alias("checked"),
        (st == "read").alias("read"),
        q.alias("quarantined"),
        F.when(q, F.when(again | (st == "quarantined"), F.col("r_status")).otherwise(F.col("q_status"))).alias("status"),
        F.when(q, F.when(st == "quarantined", F.lit(today)).otherwise(F.col("q_firstDetected"))).alias("firstDetected"),
        F.when(q, F.when(again | (st == "quarantined"), F.lit(today)).otherwise(F.col("q_lastChecked"))).alias("lastChecked"),
        (st.isin("read", "noindex", "kept-title", "untitled", "confirmed", "released", "quarantined", "not-yet-there")).alias("contradicted"),
        F.when(st == "moved", F.col("r_to")).alias("moved_to"),
        F.when(st == "moved", F.col("r_status")).alias("moved_status"),
    )


def run_counts(reconciled: DataFrame) -> DataFrame:
    """name, n: what a run reports, zeros included."""
    a, st = F.col("action"), F.col("state")
    waits = st.isin("transient", "untouched", "kept-title")
    counts = {
        "indexUrls": F.col("in_index"),
        "catalogRecords": F.col("in_catalogue"),
        "pendingNew": F.col("in_index") & ~F.col("in_catalogue") & a.isin("new", "redirecting", "changed", "kept", "bootstrapped"),
        "deferredChanged": (a == "changed") & waits,
        "deferredMissing": (a == "missing") & waits,
        "quarantined": F.col("quarantined"),
        "moved": st == "moved",
        "released": st == "released",
    }
    one = reconciled.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in counts])).alias("x")).select("x.*")


def records(reconciled: DataFrame, catalogue: DataFrame, rows: DataFrame, results: DataFrame, site: Site = Site()) -> DataFrame:
    """The catalogue after a run: path, url, title, lastmod, checked, and the catalogue's other columns.

    Those come from the page where it was read (if results has them), else from the record before.
    """
    extra = [c for c in catalogue.columns if c not in ("path", "stamped", *RECORD)]
    listed = rows.select("path", F.col("url").alias("_row"))
    full = catalogue.withColumns({c: _column(catalogue, c) for c in RECORD})
    old = pick_record(full.join(listed, "path", "left"), "path", "_row").select("path", *[F.col(c).alias(f"_o_{c}") for c in extra])
    new = results.select("path", *[(F.col(c) if c in results.columns else F.lit(None).cast(catalogue.schema[c].dataType)).alias(f"_n_{c}") for c in extra])
    kept = reconciled.where("in_catalogue").select("path", "url", "title", "lastmod", "checked", "read")
    out = kept.join(old, "path", "left").join(new, "path", "left")
    return out.select("path", "url", "title", "lastmod", "checked", *[F.when(F.col("read") & F.lit(c in results.columns), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c) for c in extra])
