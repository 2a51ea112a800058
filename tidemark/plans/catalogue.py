"""Queries over the driver's tables, each an operator of the engine on a stand-in, with the same in SQL.

Stand-ins: pages.url are links, pages.html page bodies; orders with
o_orderkey % 10 <> 0 and <> 1 are two snapshots; lineitem holds ordered unit
lists; region and nation a taxonomy; events probe results and daily snapshots;
documents catalogue records; labels a partial truth.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Scope, Site
from ..functions import paths as P
from ..functions import scalars as S
from ..functions import text as X
from ..operators import build, classify, dedupe, diff, docs, history, joins, ledger, quality, queues
from . import report, validate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- shared pieces, in Spark and in SQL

PATH = r"lower(coalesce(nullif(regexp_replace(regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1, 'i'), '^/[a-z]{2}-[a-z]{2}(/|$)', '\1', 'i'), '/+$', ''), ''), '/'))"
ANC = "unnest(list_transform(range(2, len(string_split({p}, '/')) + 1), lambda i: array_to_string(list_slice(string_split({p}, '/'), 1, i), '/')))"
SITE = Site(learn=Scope(("/en", "/fr"), ("/fr/8",)), index=Scope(("/de",)))
EVENT_KIND = {"error": "transient", "view": "live", "click": "moved", "purchase": "landing", "signup": "gone"}
PREV, NEXT = "o_orderkey % 10 <> 0", "o_orderkey % 10 <> 1"


def pages(spark, sf):
    return T(spark, sf, "pages").withColumn("path", P.canonical_path("url"))


def doc_paths(spark, sf):
    return T(spark, sf, "documents").select("doc_id", F.concat_ws("/", F.lit(""), "lang", "source", F.col("doc_id").cast("string")).alias("path"), "lang", "source", "n_chars")


DOCS = "(SELECT doc_id, '/' || lang || '/' || source || '/' || doc_id AS path, lang, source, n_chars FROM documents)"


def orders(spark, sf):
    o = T(spark, sf, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("uid"), F.concat(F.lit("/training/modules/m"), "o_orderkey").alias("path"), F.col("o_orderpriority").alias("title"), "o_orderkey", "o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


ORDERS = "(SELECT CAST(o_orderkey AS VARCHAR) AS uid, '/training/modules/m' || o_orderkey AS path, o_orderpriority AS title, o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)"


def edges(spark, sf):
    """A redirect ledger: order k moved to k * 7 % 10007, some removed, some off the site."""
    o = orders(spark, sf)
    to = F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("/p/"), F.col("o_orderkey") * 7 % 10007))
    moved = F.col("o_orderkey") % 5 != 0
    none = F.lit(None).cast("string")
    return o.where("o_orderkey % 3 <> 0").select(
        F.when(moved, "moved").otherwise("removed").alias("file"), F.concat(F.lit("/p/"), "o_orderkey").alias("path"), F.lit("docs").alias("kind"), F.lit("docs").alias("family"),
        F.when(moved, "moved").when(F.col("o_orderkey") % 2 == 0, "gone").otherwise("landing").alias("outcome"), F.when(moved, to).alias("to"), none.alias("title"), none.alias("parent"),
        F.col("day").alias("firstSeen"), F.col("day").alias("lastVerified"), F.lit("docs-redirect").alias("evidence"), F.lit(301).alias("status"),
    )


EDGES = """(SELECT CASE WHEN o_orderkey % 5 <> 0 THEN 'moved' ELSE 'removed' END AS file, '/p/' || o_orderkey AS path,
 CASE WHEN o_orderkey % 5 <> 0 THEN 'moved' WHEN o_orderkey % 2 = 0 THEN 'gone' ELSE 'landing' END AS outcome,
 CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0 THEN '/p/' || (o_orderkey * 7 % 10007) END AS "to", day, o_orderkey FROM """ + ORDERS + " WHERE o_orderkey % 3 <> 0)"


# ---- paths


@query(f"SELECT page_id, {PATH} AS path, nullif(string_split({PATH}, '/')[2], '') AS segment FROM pages")
def canonical_paths(spark, sf):
    return pages(spark, sf).select("page_id", "path", P.first_segment("path").alias("segment"))


@query(f"SELECT key, count(DISTINCT url) AS n FROM (SELECT regexp_extract({PATH}, '^(.+)/[^/]*$', 1) AS key, url FROM pages) GROUP BY key HAVING count(DISTINCT url) > 1")
def url_aliases(spark, sf):
    return dedupe.alias_duplicates(pages(spark, sf).withColumn("key", P.parent_path("path")), "key", "url")


@query("SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def exact_duplicates(spark, sf):
    return dedupe.exact_duplicates(T(spark, sf, "documents"), "text")


@query(f"""SELECT page_id, CASE WHEN regexp_matches(p, '^/en(/|$)') OR (regexp_matches(p, '^/fr(/|$)') AND NOT regexp_matches(p, '^/fr/8(/|$)')) THEN 'learn' WHEN regexp_matches(p, '^/de(/|$)') THEN 'index' END AS cls
 FROM (SELECT page_id, {PATH} AS p FROM pages)""")
def scope_class(spark, sf):
    return pages(spark, sf).select("page_id", P.scope_class("path", SITE.learn, SITE.index).alias("cls"))


@query(f"""WITH d AS (SELECT * FROM {DOCS}), x AS (SELECT DISTINCT '/' || lang AS prefix FROM d WHERE lang <> 'es' UNION SELECT DISTINCT '/' || lang || '/' || source FROM d WHERE source < 'src2'),
 a AS (SELECT doc_id, {ANC.format(p='path')} AS prefix FROM d) SELECT doc_id, max_by(prefix, length(prefix)) AS prefix FROM a JOIN x USING (prefix) GROUP BY doc_id""")
def longest_prefix(spark, sf):
    d = doc_paths(spark, sf)
    x = d.where("lang <> 'es'").select(F.concat(F.lit("/"), "lang").alias("prefix")).union(d.where("source < 'src2'").select(F.concat(F.lit("/"), "lang", F.lit("/"), "source"))).distinct()
    return joins.longest_prefix(d, x, "doc_id")


@query(f"""WITH d AS (SELECT * FROM {DOCS}) SELECT prefix, count(*) AS n FROM (SELECT {ANC.format(p='path')} AS prefix FROM d) WHERE len(string_split(prefix, '/')) = 3 GROUP BY prefix""")
def folder_counts(spark, sf):
    d = doc_paths(spark, sf)
    folders = d.select(P.parent_path("path").alias("prefix")).distinct()
    return joins.prefix_join(d, folders, itself=False).groupBy("prefix").agg(F.count("*").alias("n"))


_KIND_PATHS = ["/training/modules/m{k}", "/training/modules/m{k}/1-unit", "/training/paths/p{k}", "/training/courses/c{k}", "/credentials/certifications/resources/study-guides/s{k}", "/credentials/certifications/exams/e{k}", "/credentials/certifications/c{k}", "/credentials/applied-skills/a{k}", "/training/other/{k}/x/y", "/cloud/{k}"]
_KINDS = ["module", "unit", "path", "course", "study-guide", "exam", "certification", "applied-skill", "other", "docs"]


@query("SELECT o_orderkey, CASE o_orderkey % 10 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS)) + " END AS kind FROM orders")
def classify_path(spark, sf):
    made = F.concat(*[F.when(F.col("o_orderkey") % 10 == i, F.concat(*[F.col("o_orderkey").cast("string") if x == "{k}" else F.lit(x) for x in _split(p)])).otherwise("") for i, p in enumerate(_KIND_PATHS)])
    return T(spark, sf, "orders").select("o_orderkey", classify.classify_path(made).alias("kind"))


def _split(p: str) -> list[str]:
    a, b = p.split("{k}")
    return [x for x in (a, "{k}", b) if x]


@query("SELECT o_orderkey, unit, regexp_replace(unit, '^\\d+[a-z]?-', '') AS text FROM (SELECT o_orderkey, o_orderpriority AS unit FROM orders)")
def slug_texts(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("unit"), P.slug_text("o_orderpriority").alias("text"))


# ---- the flagship


def caches(spark, sf) -> validate.Caches:
    p = pages(spark, sf)
    return validate.Caches(
        index=p.where("page_id % 3 = 0").select("path"),
        redirects=p.where("page_id % 6 = 1").select(F.col("path").alias("from"), F.concat("path", F.lit("/new")).alias("to")),
        quarantine=p.where("page_id % 6 = 2").select("path"),
    )


_FLAG = f"""WITH p AS (SELECT page_id, {PATH} AS path FROM pages), i AS (SELECT DISTINCT path FROM p WHERE page_id % 3 = 0), r AS (SELECT DISTINCT path FROM p WHERE page_id % 6 = 1), q AS (SELECT DISTINCT path FROM p WHERE page_id % 6 = 2),
 v AS (SELECT page_id, p.path, CASE WHEN i.path IS NOT NULL THEN 'valid' WHEN r.path IS NOT NULL THEN 'moved' WHEN q.path IS NOT NULL THEN 'broken' WHEN regexp_matches(p.path, '^/(en|de)(/|$)') OR (regexp_matches(p.path, '^/fr(/|$)') AND NOT regexp_matches(p.path, '^/fr/8(/|$)')) THEN 'broken' ELSE 'unverifiable' END AS verdict,
 CASE WHEN i.path IS NULL AND r.path IS NULL AND q.path IS NULL AND (regexp_matches(p.path, '^/(en|de)(/|$)') OR (regexp_matches(p.path, '^/fr(/|$)') AND NOT regexp_matches(p.path, '^/fr/8(/|$)'))) THEN 'low' ELSE 'high' END AS confidence,
 CASE WHEN i.path IS NULL AND r.path IS NOT NULL THEN p.path || '/new' END AS redirects_to FROM p LEFT JOIN i ON i.path = p.path LEFT JOIN r ON r.path = p.path LEFT JOIN q ON q.path = p.path) """


@query(_FLAG + "SELECT * FROM v")
def validate_urls(spark, sf):
    return validate.validate(T(spark, sf, "pages"), caches(spark, sf), SITE).select("page_id", "path", "verdict", "confidence", "redirects_to")


@query(_FLAG + "SELECT CASE WHEN grouping(kind) = 0 THEN kind END AS kind, verdict, count(*) AS n FROM (SELECT 'docs' AS kind, verdict FROM v) GROUP BY GROUPING SETS ((), (verdict), (kind, verdict))")
def verdict_summary(spark, sf):
    return validate.verdict_summary(validate.validate(T(spark, sf, "pages"), caches(spark, sf), SITE))


@query(f"""SELECT o.uid, o.path, CASE WHEN o.o_orderkey % 4 = 0 AND o.o_orderkey % 8 = 0 THEN 'broken' WHEN o.o_orderkey % 4 = 0 THEN 'valid' WHEN o.o_orderkey % 4 = 1 THEN 'broken' WHEN o.o_orderkey % 4 = 2 THEN 'valid' ELSE 'broken' END AS verdict,
 CASE WHEN o.o_orderkey % 4 = 1 THEN 'tombstone' WHEN o.o_orderkey % 4 = 2 THEN 'out-of-scope' ELSE 'learn-catalog' END AS evidence FROM {ORDERS} o""")
def validate_modules(spark, sf):
    o = orders(spark, sf)
    modules = o.where("o_orderkey % 4 = 0").select("path", F.array(F.concat("path", F.lit("/1-intro"))).alias("unitUrls"), (F.col("o_orderkey") % 8 == 0).alias("hierarchyNotFound"))
    c = validate.Caches(modules=modules, modules_removed=o.where("o_orderkey % 4 = 1"), out_of_scope=o.where("o_orderkey % 4 = 2"))
    return validate.validate(o, c, SITE, url="path").select("uid", "path", "verdict", "evidence")


@query(f"""SELECT uid, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 8 <> 0 THEN (CASE WHEN o_orderkey % 3 = 0 THEN 'valid' ELSE 'broken' END) WHEN o_orderkey % 4 = 2 THEN 'unverifiable' ELSE 'broken' END AS verdict,
 CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 8 <> 0 AND o_orderkey % 3 <> 0 THEN 'https://site.example' || path || '/2-setup' END AS suggestion FROM {ORDERS}""")
def validate_units(spark, sf):
    o = orders(spark, sf)
    modules = o.where("o_orderkey % 4 = 0").select("path", F.array(*[F.concat("path", F.lit(u)) for u in ("/1-intro", "/2-setup")]).alias("unitUrls"), (F.col("o_orderkey") % 8 == 0).alias("hierarchyNotFound"))
    c = validate.Caches(modules=modules, modules_removed=o.where("o_orderkey % 4 = 1"), out_of_scope=o.where("o_orderkey % 4 = 2"))
    links = o.select("uid", F.concat("path", F.when(F.col("o_orderkey") % 3 == 0, "/1-intro").otherwise("/9-setup")).alias("url"))
    return validate.validate(links, c, SITE).select("uid", "verdict", "suggestion")


@query(_FLAG + """SELECT page_id, CASE WHEN verdict IN ('broken', 'moved') AND page_id % 4 = 1 THEN 'valid' ELSE verdict END AS verdict, CASE WHEN verdict IN ('broken', 'moved') AND page_id % 4 = 1 THEN NULL ELSE redirects_to END AS redirects_to FROM v""")
def hide_live_change(spark, sf):
    out = validate.validate(T(spark, sf, "pages"), caches(spark, sf), SITE)
    probes = pages(spark, sf).where("page_id % 4 = 1").select(F.col("page_id").alias("id"), F.lit("ok").alias("live_verdict"), F.lit(None).cast("string").alias("live_to"))
    keyed = out.drop("path").withColumn("path", F.col("page_id"))
    return validate.with_live(keyed, probes.withColumnRenamed("id", "path"), unverifiable_too=False).select("page_id", "verdict", "redirects_to")


@query("SELECT d.doc_id, CASE WHEN l.quality = 1 THEN true WHEN l.quality = 0 THEN false WHEN d.lang = 'en' THEN NULL ELSE false END AS is_live FROM documents d LEFT JOIN labels l USING (doc_id)")
def membership3(spark, sf):
    labels = T(spark, sf, "labels")
    docs = T(spark, sf, "documents").select("doc_id", "lang")
    return joins.membership3(docs, [(labels.where("quality = 1").select("doc_id"), True), (labels.where("quality = 0").select("doc_id"), False)], F.col("lang") != "en", "doc_id").select("doc_id", "is_live")


@query("""WITH l AS (SELECT p_brand AS brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos, replace(p_name, ' ', '-') AS path FROM part), d AS (SELECT DISTINCT p_brand AS brand, (p_partkey % 9) || '-' || split_part(p_name, ' ', 2) AS dead FROM part)
 SELECT brand, dead, min_by(path, rank * 1000000 + pos) AS suggestion FROM (SELECT l.brand, dead, path, pos, CASE WHEN path = dead THEN 1 WHEN t = w THEN 2 WHEN ends_with(path, w) OR ends_with(w, t) THEN 3 END AS rank
 FROM (SELECT *, regexp_replace(path, '^\\d+[a-z]?-', '') AS t FROM l) l JOIN (SELECT *, regexp_replace(dead, '^\\d+[a-z]?-', '') AS w FROM d) d USING (brand)) WHERE rank IS NOT NULL GROUP BY brand, dead""")
def suggest_slug(spark, sf):
    p = T(spark, sf, "part").withColumnRenamed("p_brand", "brand")
    lists = p.select("brand", (F.row_number().over(Window.partitionBy("brand").orderBy("p_partkey")) - 1).alias("pos"), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")).alias("path"))
    dead = p.select("brand", F.concat_ws("-", (F.col("p_partkey") % 9).cast("string"), F.split("p_name", " ")[1]).alias("dead"))
    return joins.suggest_slug(dead, lists, "brand")


# ---- text


def _decoded_sql(sql: str) -> str:
    for name, text in X.ENTITIES:
        sql = "replace(" + ", ".join([sql, *("'" + x.replace("'", "''") + "'" for x in (name, text))]) + ")"
    return sql


_TITLE = _decoded_sql("regexp_replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'si'), '<[^>]*>', '', 'g')")


@query(f"SELECT page_id, nullif(trim(regexp_replace({_TITLE}, '[\\s\u00a0]+', ' ', 'g')), '') AS title FROM pages")
def page_title(spark, sf):
    """A row for every page; the SQL knows named entities only."""
    return T(spark, sf, "pages").select("page_id", X.page_title("html").alias("title"))


@query("SELECT page_id, len(h) AS links, h[1] AS href FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*?href=[\"'']([^\"'']*)[\"''][^>]*>.*?</a\\s*>', 1, 'si') AS h FROM pages)")
def page_anchors(spark, sf):
    a = T(spark, sf, "pages").select("page_id", X.anchors("html").alias("a"))
    return a.select("page_id", F.size("a").cast("long").alias("links"), F.get("a", F.lit(0)).href.alias("href"))


@query("SELECT page_id, regexp_extract(html, '<html[^>]*lang=\"([^\"]*)\"', 1) AS lang, len(string_split_regex(html, '(?i)<p\\b[^>]*>')) AS parts FROM pages")
def sections(spark, sf):
    return T(spark, sf, "pages").select("page_id", F.regexp_extract("html", r'<html[^>]*lang="([^"]*)"', 1).alias("lang"), F.size(X.sections("html", "p")).cast("long").alias("parts"))


@query("SELECT page_id, length(regexp_extract(html, '</h1>(.*?)</article>', 1, 's')) AS chars FROM pages WHERE regexp_matches(html, '</h1>.*?</article>', 's')")
def article_text(spark, sf):
    a = T(spark, sf, "pages").select("page_id", X.between("html", "</h1>", "</article>").alias("a")).where("a is not null")
    return a.select("page_id", F.length("a").cast("long").alias("chars"))


@query()
def head_meta(spark, sf):
    return T(spark, sf, "pages").select("page_id", X.head_meta("html").alias("m")).select("page_id", F.to_json("m").alias("meta"))


@query()
def page_links(spark, sf):
    return X.page_links(T(spark, sf, "pages"), "html", "page_id", "p")


@query("""SELECT page_id, CASE WHEN regexp_matches(h, '^/training(/|$)') THEN 'training' WHEN regexp_matches(h, '^/(credentials|shows|answers|collections|events|users|contribute|assessments)(/|$)') THEN 'learn-other' ELSE 'docs' END AS kind, count(*) AS n
 FROM (SELECT page_id, lower(unnest(regexp_extract_all(html, 'href="(/[^"?#]*)"', 1))) AS h FROM pages) GROUP BY ALL""")
def link_kinds(spark, sf):
    h = T(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="(/[^"?#]*)"'), 1)).alias("h"))
    return h.groupBy("page_id", classify.link_kind(F.lower("h")).alias("kind")).agg(F.count("*").alias("n"))


@query("""SELECT '/c/' || conv_id AS folder, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY role) - 1 AS INT) AS ord, role AS title, string_agg('t' || turn, ',' ORDER BY 't' || turn) AS pages FROM conversations WHERE turn IS NOT NULL GROUP BY conv_id, role""")
def toc_groups(spark, sf):
    """Sidebars from conversations: a group per role, its turns the pages."""
    c = T(spark, sf, "conversations").where("turn is not null")
    item = F.struct(F.col("role").alias("toc_title"), F.concat(F.lit("t"), "turn").alias("href"))
    g = c.groupBy("conv_id", "role").agg(F.sort_array(F.collect_list(item)).alias("children"))
    t = g.groupBy("conv_id").agg(F.to_json(F.struct(F.sort_array(F.collect_list(F.struct(F.col("role").alias("toc_title"), "children"))).alias("items"))).alias("toc"))
    flat = X.flatten_toc(t.select(F.concat(F.lit("/c/"), "conv_id").alias("folder"), "toc"))
    return flat.select("folder", "ord", F.array_join("title", " / ").alias("title"), F.array_join("pages", ",").alias("pages"))


# ---- winners and rows


@query("""SELECT path, lastmod, url FROM (SELECT '/u/' || user_id AS path, strftime(ts, '%Y-%m-%d') AS lastmod, '/u/' || user_id || '?e=' || event_id AS url, row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, '%Y-%m-%d') DESC, '/u/' || user_id || '?e=' || event_id) AS n FROM events) WHERE n = 1""")
def sitemap_rows_dedupe(spark, sf):
    e = T(spark, sf, "events")
    rows = e.select(F.concat(F.lit("/u/"), "user_id").alias("path"), F.date_format("ts", "yyyy-MM-dd").alias("lastmod"), F.concat(F.lit("/u/"), "user_id", F.lit("?e="), "event_id").alias("url"))
    return dedupe.dedupe_rows(rows)


@query(f"""SELECT uid, path, winner FROM (SELECT uid, '/c/' || o_custkey AS path, row_number() OVER w AS n, first_value(uid) OVER w AS winner FROM {ORDERS} WINDOW w AS (PARTITION BY o_custkey ORDER BY day DESC, uid)) WHERE n > 1""")
def path_collisions(spark, sf):
    return dedupe.path_collisions(orders(spark, sf).select("uid", F.concat(F.lit("/c/"), "o_custkey").alias("path"), F.col("day").alias("lastModified")))


@query("""SELECT 'u' || user_id AS path, min(strftime(ts, '%Y-%m-%d')) AS "firstDetected", max(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS "lastChecked", max_by(CAST(event_id % 600 AS INT), (strftime(ts, '%Y-%m-%d %H:%M:%S'), event_id % 600)) AS status FROM events GROUP BY user_id""")
def fold_quarantine(spark, sf):
    """Events as checks of users; of a user's checks in the same last second, the greatest status comes first."""
    e = T(spark, sf, "events").select(F.concat(F.lit("u"), "user_id").alias("path"), F.date_format("ts", "yyyy-MM-dd").alias("firstDetected"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("lastChecked"), (F.col("event_id") % 600).cast("int").alias("status"))
    return dedupe.fold_quarantine(e.withColumn("ordinal", -F.col("status")), ordinal="ordinal")


# ---- classes of redirects and probes


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'retired' WHEN o_orderkey % 5 IN (1, 2) THEN 'landing' WHEN o_orderkey % 5 = 3 THEN 'landing' ELSE 'moved' END AS cls FROM orders""")
def redirect_class(spark, sf):
    k = F.col("o_orderkey")
    to = F.when(k % 5 == 0, F.concat(F.lit("/previous-versions/"), k)).when(k % 5 == 1, F.lit("/cloud/vm")).when(k % 5 == 2, F.lit("/store")).when(k % 5 == 3, F.lit("/training/browse")).otherwise(F.concat(F.lit("/cloud/new/"), k))
    return T(spark, sf, "orders").select("o_orderkey", classify.classify_redirect(F.concat(F.lit("/cloud/vm/"), k), to).alias("cls"))


_STATUS = "CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 404 ELSE 200 END"


@query("SELECT event_id, CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in {**EVENT_KIND, "purchase": "moved"}.items()) + " END AS outcome, CASE event_type WHEN 'click' THEN 'moved' WHEN 'purchase' THEN 'landing' END AS kind FROM events")
def probe_class(spark, sf):
    e = T(spark, sf, "events")
    path = F.concat(F.lit("/docs/x/u"), "user_id")
    final = F.when(F.col("event_type") == "view", path).when(F.col("event_type") == "click", F.concat(F.lit("/docs/y/u"), "user_id")).otherwise(F.lit("/docs"))
    p = classify.classify_probe(F.expr(_STATUS), F.lit(None).cast("int"), final, path, F.lit(False), F.lit(False))
    return e.select("event_id", p.outcome.alias("outcome"), p.kind.alias("kind"))


@query("SELECT event_id, CASE event_type WHEN 'error' THEN 'transient' WHEN 'signup' THEN 'gone' WHEN 'view' THEN 'live' WHEN 'click' THEN 'moved' ELSE 'landing' END AS outcome FROM events")
def learn_probe_class(spark, sf):
    e = T(spark, sf, "events")
    path = F.concat(F.lit("/training/modules/m"), "user_id")
    final = F.when(F.col("event_type") == "view", path).when(F.col("event_type") == "click", F.concat(F.lit("/training/modules/n"), "user_id")).otherwise(F.lit("/training/browse"))
    shape = classify.shape_of(final, F.lit(False), F.lit(False))
    return e.select("event_id", classify.classify_learn_probe(F.lit("module"), path, F.expr(_STATUS), F.lit(None).cast("int"), final, F.lit(None).cast("string"), F.lit(False), F.lit(False), shape).outcome.alias("outcome"))


# ---- ledger


_HOP = "LEFT JOIN e e{n} ON e{n}.path = e{m}.\"to\" AND e{m}.file = 'moved'"
_CHASE = f"""WITH RECURSIVE e AS (SELECT * FROM {EDGES}), w AS (
 SELECT path AS link, path AS cur, 0 AS hops, [path] AS chain, file, outcome, "to", CASE WHEN file = 'removed' THEN 'removed' WHEN "to" IS NULL THEN 'off' WHEN "to" = path THEN 'cycle' END AS stop FROM e
 UNION ALL
 SELECT w.link, w."to", w.hops + 1, list_append(w.chain, w."to"), x.file, coalesce(x.outcome, w.outcome), x."to",
 CASE WHEN x.path IS NULL THEN 'moved' WHEN x.file = 'removed' THEN 'removed' WHEN x."to" IS NULL THEN 'off' WHEN list_contains(list_append(w.chain, w."to"), x."to") THEN 'cycle' WHEN w.hops + 1 >= 5 THEN 'truncated' END
 FROM w LEFT JOIN e x ON x.path = w."to" WHERE w.stop IS NULL AND w.hops < 6)
 SELECT link, CASE WHEN stop = 'removed' THEN 'removed' ELSE 'moved' END AS state, outcome, CASE WHEN stop IN ('cycle', 'truncated') THEN 'low' ELSE 'high' END AS confidence, CASE stop WHEN 'moved' THEN cur WHEN 'cycle' THEN "to" WHEN 'truncated' THEN cur END AS "to", CAST(len(chain) AS BIGINT) AS steps FROM w WHERE stop IS NOT NULL"""


@query(_CHASE)
def ledger_chase(spark, sf):
    e = edges(spark, sf)
    out = joins.lookup_changes(e, e)
    return out.select("link", "state", "outcome", "confidence", "to", F.size("chain").cast("long").alias("steps"))


@query(f"""WITH a AS (SELECT path AS start, outcome AS kind, day FROM {EDGES} WHERE o_orderkey % 4 <> 0), d AS (SELECT path AS start, 'moved' AS kind FROM {EDGES} WHERE o_orderkey % 4 <> 1), x AS (SELECT path AS start FROM {EDGES} WHERE o_orderkey % 7 = 0)
 SELECT coalesce(k.start, d.start) AS "from", coalesce(d.kind, k.kind) AS kind, coalesce(k.day, '2024-06-01') AS "firstSeen", CASE WHEN d.start IS NOT NULL THEN '2024-06-01' ELSE k.day END AS "lastSeen" FROM (SELECT * FROM a WHERE start NOT IN (SELECT start FROM x)) k FULL JOIN d ON d.start = k.start""")
def ledger_update(spark, sf):
    e = edges(spark, sf).withColumn("k", P.last_segment("path").cast("long"))
    row = lambda df: df.select(F.col("path").alias("from"), "to", F.col("outcome").alias("kind"), "status", "firstSeen", F.col("lastVerified").alias("lastSeen"))
    found = row(e.where("k % 4 <> 1").withColumn("outcome", F.lit("moved")))
    none = e.limit(0).select("path")
    return ledger.update_redirects(row(e.where("k % 4 <> 0")), found, e.where("k % 7 = 0"), none, none, "2024-06-01").select("from", "kind", "firstSeen", "lastSeen")


def _apply(spark, sf):
    o = orders(spark, sf)
    none = F.lit(None).cast("string")
    old = o.where("o_orderkey % 4 = 0").select(F.lit("removed").alias("file"), "path", F.lit("module").alias("kind"), F.lit("learn").alias("family"), F.lit("unverified").alias("outcome"), none.alias("to"), "title", none.alias("parent"), F.col("day").alias("firstSeen"), none.alias("lastVerified"), F.lit("tombstone").alias("evidence"), F.lit(None).cast("int").alias("status"))
    new = o.where("o_orderkey % 4 in (0, 1)").select("path", F.lit("module").alias("kind"), none.alias("parent"), "title", F.lit("rename").alias("evidence"), F.lit("2023-06-01").alias("firstSeen"))
    results = o.where("o_orderkey % 3 = 0").select("path", F.when(F.col("o_orderkey") % 9 == 0, "transient").when(F.col("o_orderkey") % 2 == 0, "moved").otherwise("gone").alias("outcome"), F.concat("path", F.lit("-new")).alias("to"), F.lit(301).alias("status"))
    return ledger.apply_changes(old, new, results, o.where("o_orderkey % 25 = 0").select("path"), "learn", "2024-06-02")


_APPLY = f"""(SELECT path, CASE WHEN told AND o_orderkey % 2 = 0 THEN 'moved' ELSE 'removed' END AS file, CASE WHEN NOT told THEN 'unverified' WHEN o_orderkey % 2 = 0 THEN 'moved' ELSE 'gone' END AS outcome, CASE WHEN told AND o_orderkey % 2 = 0 THEN path || '-new' END AS "to",
 CASE WHEN o_orderkey % 4 = 0 THEN day ELSE '2023-06-01' END AS "firstSeen", CASE WHEN told THEN '2024-06-02' END AS "lastVerified", CASE WHEN o_orderkey % 4 = 0 THEN 'tombstone' ELSE 'rename' END AS evidence
 FROM (SELECT *, o_orderkey % 3 = 0 AND o_orderkey % 9 <> 0 AS told FROM {ORDERS} WHERE o_orderkey % 4 IN (0, 1) AND o_orderkey % 25 <> 0))"""


@query(f"SELECT * FROM {_APPLY}")
def apply_changes(spark, sf):
    return _apply(spark, sf).select("path", "file", "outcome", "to", "firstSeen", "lastVerified", "evidence")


@query(f"SELECT path, \"firstSeen\" FROM {_APPLY} WHERE \"firstSeen\" >= '2000-01-01'")
def changes_since(spark, sf):
    return ledger.changes_since(_apply(spark, sf), "2000-01-01").select("path", "firstSeen")


_OUT = ("gone", "landing", "retired", "unverified", "moved")


@query(f"""WITH a AS (SELECT * FROM {_APPLY}), n AS (SELECT 'total' AS dimension, 'all' AS name UNION ALL SELECT 'outcome', unnest({list(_OUT)}) UNION ALL SELECT 'family', unnest(['learn', 'docs'])), f AS (SELECT unnest(['removed', 'moved']) AS file)
 SELECT dimension, name, f.file, (SELECT count(*) FROM a WHERE a.file = f.file AND (dimension = 'total' OR (dimension = 'outcome' AND a.outcome = name) OR (dimension = 'family' AND name = 'learn'))) AS n FROM n, f""")
def changes_summary(spark, sf):
    return ledger.summary(_apply(spark, sf)).where("dimension <> 'kind'")


@query(f"""SELECT path, outcome FROM (SELECT path, 'old' AS outcome FROM {ORDERS} WHERE o_orderstatus <> 'F' UNION ALL SELECT path, 'gone' FROM {ORDERS} WHERE o_orderstatus = 'F' AND o_orderkey % 2 = 0)""")
def replace_family(spark, sf):
    o = orders(spark, sf)
    make = lambda df, outcome: df.select(*[F.lit(None).cast("int" if c == "status" else "string").alias(c) if c not in ("path", "family", "outcome") else F.col("path") if c == "path" else F.col("o_orderstatus").alias(c) if c == "family" else F.lit(outcome).alias(c) for c in ledger.COLUMNS])
    return ledger.replace_family(make(o, "old"), "F", make(o.where("o_orderkey % 2 = 0"), "gone")).select("path", "outcome")


# ---- snapshot differences


@query(f"SELECT uid, path, title, '2024-05-31' AS \"lastSeen\", '2024-06-01' AS \"removedOn\" FROM {ORDERS} WHERE o_orderkey % 10 = 1")
def diff_tombstones(spark, sf):
    o = orders(spark, sf)
    carried = o.where("o_orderkey % 10 in (5, 6)").select("uid", "path", "title", F.lit("2024-01-01").alias("lastSeen"), F.lit("2024-01-02").alias("removedOn"))
    return diff.tombstones(o.where(PREV), carried, o.where(NEXT), ["uid"], "2024-06-01", "2024-05-31")


@query(f"SELECT uid, path, path || '-v2' AS \"to\" FROM {ORDERS} WHERE {PREV} AND {NEXT} AND o_orderkey % 7 = 0")
def diff_renames(spark, sf):
    o = orders(spark, sf).select("uid", "path", "o_orderkey")
    new = o.where(NEXT).withColumn("path", F.when(F.col("o_orderkey") % 7 == 0, F.concat("path", F.lit("-v2"))).otherwise(F.col("path")))
    return diff.renames(o.where(PREV), new.select("uid", "path"), ["uid"])


def _units(spark, sf):
    li = T(spark, sf, "lineitem")
    one = F.concat(F.lit("/m/"), "l_orderkey", F.lit("/"), "l_linenumber", F.lit("-"), "l_partkey")
    return li.groupBy(F.concat(F.lit("/m/"), "l_orderkey").alias("path")).agg(F.sort_array(F.collect_set(one)).alias("unitUrls"))


@query("""WITH u AS (SELECT '/m/' || l_orderkey AS path, list_sort(list(DISTINCT '/m/' || l_orderkey || '/' || l_linenumber || '-' || l_partkey)) AS o FROM lineitem GROUP BY l_orderkey), d AS (SELECT path, o, CASE WHEN len(o) > 2 THEN list_slice(o, 1, len(o) - 2) ELSE [] END AS n FROM u)
 SELECT path AS parent, unnest(list_slice(o, len(o) - 1, len(o))) AS path, 'unit' AS kind FROM d WHERE len(n) > 0 AND len(n) * 2 >= len(o)""")
def diff_units(spark, sf):
    u = _units(spark, sf)
    n = u.select("path", F.slice("unitUrls", F.lit(1), F.greatest(F.size("unitUrls") - 2, F.lit(0))).alias("unitUrls"))
    return diff.diff_units(u, n, "2024-06-01").select("parent", "path", "kind")


@query(f"SELECT uid, CASE WHEN o_orderkey % 10 = 0 THEN 'added' WHEN o_orderkey % 10 = 1 THEN 'removed' WHEN o_orderkey % 7 = 0 THEN 'changed' ELSE 'same' END AS action FROM {ORDERS}")
def changed_rows(spark, sf):
    o = orders(spark, sf).select("uid", "path", "o_orderkey")
    new = o.where(NEXT).withColumn("path", F.when(F.col("o_orderkey") % 7 == 0, F.lit("x")).otherwise(F.col("path")))
    return diff.changed_rows(o.where(PREV), new, "uid")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 4 <> 0 THEN l_suppkey WHEN l_orderkey % 2 = 0 THEN l_suppkey END AS l_suppkey FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1)""")
def carry_forward(spark, sf):
    """The first line of every order, whatever its number."""
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    one = dedupe.first_per(li, ["l_orderkey"], [F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")])
    holes = one.withColumn("l_suppkey", F.when(F.col("l_partkey") % 4 != 0, F.col("l_suppkey")))
    return diff.carry_forward(holes, one, "l_orderkey", "l_suppkey", F.col("l_orderkey") % 2 == 0)


# ---- catalogue building


def _taxonomy(spark, sf):
    n = T(spark, sf, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("name")))).alias("children"))
    return T(spark, sf, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey")).select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.col("r_name").alias("name"), "children")


@query("SELECT 's' || s_suppkey AS uid, 'r' || n_regionkey AS \"top\", n_name AS name FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def taxonomy_categories(spark, sf):
    t = build.flatten_taxonomy(_taxonomy(spark, sf))
    m = T(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("uid"), F.array(F.concat(F.lit("n"), "s_nationkey")).alias("products"))
    return build.categories(m, t, "products").select("uid", F.get("tops", F.lit(0)).alias("top"), F.get("names", F.lit(0)).alias("name"))


@query("SELECT 'c' || c_custkey AS uid, n_regionkey IN (0, 1, 2) AS in_scope FROM customer JOIN nation ON n_nationkey = c_nationkey")
def out_of_scope(spark, sf):
    t = build.flatten_taxonomy(_taxonomy(spark, sf))
    m = T(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("uid"), F.array(F.concat(F.lit("n"), "c_nationkey")).alias("products"))
    inside, outside = build.split_scope(m, build.categories(m, t, "products"), ["r0", "r1", "r2"])
    return inside.select("uid", F.lit(True).alias("in_scope")).unionByName(outside.select("uid", F.lit(False).alias("in_scope")))


@query("""SELECT 'n' || n_nationkey AS id, CASE WHEN n_nationkey % 5 = 0 THEN 'exempt' WHEN n_nationkey % 5 = 1 THEN 'new' WHEN n_nationkey % 5 = 2 THEN 'still-empty' WHEN EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_suppkey % 2 = 0) THEN 'problem' WHEN EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey) THEN 'emptied' ELSE 'new' END AS state
 FROM nation WHERE n_nationkey % 3 <> 0""")
def category_coverage(spark, sf):
    n = T(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), "n_nationkey")
    s = T(spark, sf, "supplier")
    uids = s.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.collect_list("s_suppkey").alias("uids"))
    previous = n.where("n_nationkey % 5 > 2").join(uids, "n_nationkey").select("id", "uids").unionByName(n.where("n_nationkey % 5 = 2").select("id", F.array().cast("array<bigint>").alias("uids")))
    counts = n.select("id", F.when(F.col("n_nationkey") % 3 == 0, 1).otherwise(0).alias("n"))
    return quality.category_coverage(n, counts, previous, n.where("n_nationkey % 5 = 0"), s.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("uid")))


def _lines(spark, sf):
    """Orders with their part keys in order of line."""
    li = T(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda x: x.l_partkey).alias("ids"))


@query("""SELECT l_orderkey, coalesce(string_agg(CASE WHEN p_size % 3 <> 0 THEN p_name END, '|' ORDER BY l_linenumber, l_partkey, l_suppkey), '') AS names, count(*) FILTER (WHERE p_size % 3 = 0 OR p_partkey IS NULL) AS unresolved FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""")
def resolve_ordered_refs(spark, sf):
    names = T(spark, sf, "part").where("p_size % 3 <> 0").select("p_partkey", "p_name")
    out = joins.ordered_lookup(_lines(spark, sf), "l_orderkey", "ids", names, "p_partkey", "p_name")
    return out.select("l_orderkey", F.array_join("names", "|").alias("names"), "unresolved")


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS uid, string_agg(DISTINCT code, ',' ORDER BY code) AS exams FROM (SELECT l_orderkey, CASE WHEN l_partkey % 3 = 0 THEN 'c' || l_partkey ELSE 'x-' || l_partkey END AS code FROM lineitem) GROUP BY l_orderkey""")
def fallback_codes(spark, sf):
    certs = _lines(spark, sf).select(F.col("l_orderkey").cast("string").alias("uid"), F.transform("ids", lambda x: F.concat(F.lit("exam.X-"), x)).alias("exams"))
    exams = T(spark, sf, "part").where("p_partkey % 3 = 0").select(F.concat(F.lit("exam.X-"), "p_partkey").alias("uid"), F.concat(F.lit("c"), "p_partkey").alias("code"))
    return build.exam_codes(certs, exams).select("uid", F.array_join("exams", ",").alias("exams"))


@query("""SELECT DISTINCT '/part/' || p_partkey AS path FROM part WHERE p_size = 1 OR p_partkey IN (SELECT l_partkey FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey)""")
def scope_three_hop(spark, sf):
    """All customers: those in MACHINERY are guides, the others courses; parts of size 1 are listed directly."""
    c = T(spark, sf, "customer").select("c_custkey", F.coalesce(F.col("c_mktsegment") == "MACHINERY", F.lit(False)).alias("guide"))
    lists = c.join(T(spark, sf, "orders"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_custkey", "guide").agg(F.collect_set(F.concat(F.lit("o"), "o_orderkey")).alias("refs"))
    lp = _lines(spark, sf).select(F.concat(F.lit("o"), "l_orderkey").alias("uid"), F.transform("ids", lambda x: F.concat(F.lit("p"), x)).alias("modules"))
    parts = T(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("uid"), F.concat(F.lit("/part/"), "p_partkey").alias("path"), "p_size")
    return joins.scope_modules(lists.where(~F.col("guide")), lists.where("guide"), lp, parts.where("p_size = 1"), parts)


@query("""SELECT CAST(conv_id AS VARCHAR) AS uid, sha1('s' || conv_id || chr(10) || string_agg(CAST(turn AS VARCHAR) || ':' || role, chr(10) ORDER BY turn)) AS "unitSig" FROM (SELECT DISTINCT conv_id, turn, role FROM conversations QUALIFY count(*) OVER (PARTITION BY conv_id, turn) = 1) GROUP BY conv_id""")
def unit_signature(spark, sf):
    c = T(spark, sf, "conversations").select("conv_id", "turn", "role").distinct()
    c = c.withColumn("n", F.count("*").over(Window.partitionBy("conv_id", "turn"))).where("n = 1")
    unit = F.concat_ws(".", "conv_id", "turn")
    # a unit's uid is its turn; stamps are the roles
    units = c.select(unit.alias("id"), "role")
    m = c.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", unit.alias("id")))), lambda x: x.id).alias("ids"))
    one = m.select(F.col("conv_id").cast("string").alias("uid"), "ids", F.concat(F.lit("s"), "conv_id").alias("mod"))
    lines = one.select("uid", "mod", F.posexplode("ids").alias("pos", "id")).join(units, "id").groupBy("uid", "mod").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.concat_ws(":", F.substring_index("id", ".", -1), "role").alias("t")))), lambda x: x.t).alias("t"))
    return lines.select("uid", S.sha1_lines(F.col("mod"), F.col("t")).alias("unitSig"))


# ---- plans and queues


#: Every order is a path of the read scope, every 17th one of the scope that is only listed.
DOCS_SITE = Site(learn=Scope(("/training",), ("/training/modules/x",)), index=Scope(("/ref",)))
_K = {"s": "o_orderkey % 10 <> 1", "c": "o_orderkey % 10 <> 0 AND o_orderkey % 17 <> 0", "i": "o_orderkey % 9 <> 0", "q": "o_orderkey % 13 = 0", "r": "o_orderkey % 19 < 5", "untitled": "o_orderkey % 11 = 0", "unstamped": "o_orderkey % 7 = 0", "newer": "o_orderkey % 6 = 0"}
_PLAN = """(SELECT *, CASE WHEN q THEN 'quarantined' WHEN s AND o_orderkey % 17 = 0 THEN 'index-only' WHEN s AND NOT c AND r AND i THEN 'redirecting' WHEN s AND NOT c THEN 'new' WHEN s AND untitled THEN 'changed'
 WHEN s AND unstamped THEN 'bootstrapped' WHEN s AND newer THEN 'changed' WHEN s THEN 'kept' WHEN c OR i THEN 'missing' END AS action, CASE WHEN o_orderkey % 17 = 0 THEN '/ref/m' ELSE '/training/modules/m' END || o_orderkey AS path
 FROM (SELECT o_orderkey, """ + ", ".join(f"{v} AS {k}" for k, v in _K.items()) + " FROM orders))"


def _plan(spark, sf):
    o = orders(spark, sf)
    o = o.withColumn("path", F.when(F.col("o_orderkey") % 17 == 0, F.concat(F.lit("/ref/m"), "o_orderkey")).otherwise(F.col("path"))).withColumn("url", F.concat(F.lit("https://site.example"), "path"))
    flag = {k: F.expr(v) for k, v in _K.items()}
    sitemap = o.where(flag["s"]).select("path", "url", F.when(flag["newer"], "2024-06-01").otherwise(F.col("day")).alias("lastmod"))
    catalogue = o.where("o_orderkey % 10 <> 0").select("path", "url", F.when(~flag["untitled"], F.col("title")).alias("title"), F.when(~flag["unstamped"], F.col("day")).alias("lastmod"), F.lit("2024-05-01").alias("checked"))
    quarantine = o.where(flag["q"]).select("path", "url", F.when(~flag["untitled"], F.col("title")).alias("title"), F.lit(404).alias("status"), F.col("day").alias("firstDetected"), F.col("day").alias("lastChecked"))
    redirects = o.select(F.col("path").alias("from"), F.when(flag["r"], "2024-05-20").otherwise("2024-01-01").alias("lastSeen"))
    return docs.plan(sitemap, catalogue, o.where(flag["i"]).select("path", F.col("day").alias("lastmod")), quarantine, redirects, "2024-06-01", DOCS_SITE)


@query(f"""SELECT path, action, CASE WHEN action = 'changed' THEN CASE WHEN untitled THEN 'untitled' ELSE 'lastmod' END END AS reason FROM {_PLAN} WHERE action IS NOT NULL""")
def plan_actions(spark, sf):
    return _plan(spark, sf).select("path", "action", "reason")


_STATES = f"""(SELECT *, CASE WHEN action IN ('index-only', 'redirecting') OR o IS NULL THEN 'untouched' WHEN o = 'transient' THEN 'transient' WHEN o = 'moved' THEN 'moved' WHEN o = 'gone' AND action = 'quarantined' THEN 'still-gone'
 WHEN o = 'gone' AND action = 'new' THEN 'not-yet-there' WHEN o = 'gone' THEN 'quarantined' WHEN action = 'quarantined' THEN 'released' WHEN action IN ('new', 'changed') AND o_orderkey % 8 = 1 THEN 'noindex'
 WHEN action IN ('new', 'changed') AND o_orderkey % 4 <> 0 THEN 'read' WHEN action = 'changed' AND NOT untitled THEN 'kept-title' WHEN action IN ('new', 'changed') THEN 'untitled' ELSE 'confirmed' END AS state
 FROM (SELECT *, CASE o_orderkey % 5 WHEN 1 THEN 'transient' WHEN 2 THEN 'moved' WHEN 3 THEN 'gone' WHEN 4 THEN 'live' END AS o FROM {_PLAN} WHERE action IS NOT NULL))"""
_HELD = "((action = 'quarantined' AND state NOT IN ('released', 'moved')) OR state = 'quarantined')"


def _reconciled(spark, sf):
    k = F.col("o_orderkey")
    o = orders(spark, sf).withColumn("path", F.when(k % 17 == 0, F.concat(F.lit("/ref/m"), "o_orderkey")).otherwise(F.col("path")))
    outcome = F.when(k % 5 == 1, "transient").when(k % 5 == 2, "moved").when(k % 5 == 3, "gone").otherwise("live")
    results = o.where("o_orderkey % 5 <> 0").select("path", outcome.alias("outcome"), F.lit(404).alias("status"), F.concat("path", F.lit("-v2")).alias("to"), F.when(k % 4 != 0, F.col("title")).alias("title"), (k % 8 == 1).alias("noindex"))
    return docs.reconcile(_plan(spark, sf), results, "2024-06-01", DOCS_SITE)


@query(f"""SELECT path, action, state, (s OR (action = 'missing' AND state NOT IN ('moved', 'quarantined')) OR state = 'released') AND NOT {_HELD} AS in_index,
 CASE WHEN {_HELD} OR o_orderkey % 17 = 0 THEN false WHEN state IN ('noindex', 'untitled') THEN false WHEN state = 'moved' AND action <> 'quarantined' THEN false WHEN state = 'read' THEN true WHEN state = 'released' AND NOT untitled THEN true ELSE c END AS in_catalogue,
 {_HELD} AS quarantined, state IN ('read', 'noindex', 'kept-title', 'untitled', 'confirmed', 'released', 'quarantined', 'not-yet-there') AS contradicted, CASE WHEN state = 'moved' THEN path || '-v2' END AS moved_to FROM {_STATES}""")
def reconcile_actions(spark, sf):
    return _reconciled(spark, sf).select("path", "action", "state", "in_index", "in_catalogue", "quarantined", "contradicted", "moved_to")


@query(f"""SELECT path, CASE WHEN state = 'read' THEN CASE WHEN s THEN (CASE WHEN newer THEN '2024-06-01' ELSE day END) END WHEN state = 'released' AND NOT untitled THEN 'released' WHEN action = 'bootstrapped' THEN CASE WHEN newer THEN '2024-06-01' ELSE day END WHEN c AND NOT unstamped THEN day END AS lastmod,
 CASE WHEN state IN ('read', 'confirmed') OR (state = 'released' AND NOT untitled) THEN '2024-06-01' WHEN c THEN '2024-05-01' END AS checked, CASE WHEN {_HELD} THEN CASE WHEN state = 'quarantined' THEN '2024-06-01' ELSE day END END AS "firstDetected",
 CASE WHEN {_HELD} THEN CASE WHEN state IN ('quarantined', 'still-gone') THEN '2024-06-01' ELSE day END END AS "lastChecked" FROM (SELECT x.*, strftime(o_orderdate, '%Y-%m-%d') AS day FROM {_STATES} x JOIN orders USING (o_orderkey))""")
def reconcile_dates(spark, sf):
    return _reconciled(spark, sf).select("path", "lastmod", "checked", "firstDetected", "lastChecked")


@query("""SELECT doc_id FROM documents ORDER BY CASE WHEN n_chars % 3 = 0 THEN '' ELSE lpad(CAST(n_chars AS VARCHAR), 9, '0') END, doc_id LIMIT 200""")
def verify_queue(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") % 3 != 0, F.lpad(F.col("n_chars").cast("string"), 9, "0")).alias("checked"), F.col("doc_id").alias("url"))
    return queues.order_by_checked(d).limit(200).select("doc_id")


@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'new' ELSE 'changed' END AS kind, n_chars FROM documents), n AS (SELECT count(*) FILTER (WHERE kind = 'new') AS f, count(*) FILTER (WHERE kind = 'changed') AS c FROM d)
 SELECT doc_id, kind FROM (SELECT d.*, row_number() OVER (PARTITION BY kind ORDER BY n_chars DESC, doc_id) AS r FROM d), n WHERE r <= CASE kind WHEN 'changed' THEN least(c, 100 - least(f, 20)) ELSE least(f, 100 - least(c, 100 - least(f, 20))) END""")
def quota_split(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 5 == 0, "new").otherwise("changed").alias("kind"), "n_chars")
    return queues.take_budget(d, 100, [F.desc("n_chars"), F.asc("doc_id")]).select("doc_id", "kind")


_FNV = "list_reduce(list_prepend(CAST(2166136261 AS BIGINT), list_transform(string_split({x}, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda h, c: (xor(h, c) * 16777619) & 4294967295)"


@query(f"SELECT doc_id, {_FNV.format(x=chr(39) + '/d/' + chr(39) + ' || doc_id || ' + chr(39) + '|2024-06-01' + chr(39))} AS h FROM documents")
def hash_rotation(spark, sf):
    return T(spark, sf, "documents").select("doc_id", S.fnv32(F.concat(F.lit("/d/"), "doc_id", F.lit("|2024-06-01"))).alias("h"))


@query(f"""WITH d AS (SELECT doc_id, '/d/' || doc_id AS path, doc_id % 3 <> 0 AS has_record, n_chars, {_FNV.format(x=chr(39) + '/d/' + chr(39) + ' || doc_id || ' + chr(39) + '|2024-06-01' + chr(39))} AS h FROM documents)
 (SELECT path FROM d WHERE has_record ORDER BY n_chars, path LIMIT 50) UNION ALL (SELECT path FROM d WHERE NOT has_record ORDER BY h, path LIMIT 50)""")
def missing_batch(spark, sf):
    d = T(spark, sf, "documents").select(F.concat(F.lit("/d/"), "doc_id").alias("path"), (F.col("doc_id") % 3 != 0).alias("has_record"), F.col("n_chars").alias("checked"))
    return queues.missing_batch(d.withColumn("url", F.col("path")), 100, "2024-06-01").select("path")


@query("""SELECT event_id, row_number() OVER (ORDER BY tier, ts, event_id) AS queue_pos FROM (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY ts, event_id) AS r FROM (SELECT *, CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS tier FROM events)) WHERE tier < 3 OR r <= 40 QUALIFY queue_pos <= 5000""")
def tiered_queue(spark, sf):
    e = T(spark, sf, "events").withColumn("tier", F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "click", 2).otherwise(3))
    return queues.tiered(e, "tier", [F.asc("ts"), F.asc("event_id")], 5000, {3: 40}).select("event_id", "queue_pos")


@query(f"""SELECT path, reason, row_number() OVER (ORDER BY t, h NULLS FIRST, path) AS queue_pos FROM (SELECT path, CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 2 END AS t, CASE WHEN o_orderkey % 4 = 0 THEN 'new' ELSE 'changed' END AS reason, CASE WHEN o_orderkey % 4 <> 0 THEN day END AS h FROM {ORDERS} WHERE o_orderkey % 4 = 0 OR o_orderkey % 9 = 0) QUALIFY queue_pos <= 4000""")
def harvest_plan(spark, sf):
    o = orders(spark, sf)
    modules = o.select("path", F.when(F.col("o_orderkey") % 9 == 0, "b").otherwise("a").alias("unitSig"))
    return queues.harvest_plan(modules, o.where("o_orderkey % 4 <> 0").select("path", F.lit("a").alias("unitSig"), F.col("day").alias("harvestedAt")), 4000)


@query("""SELECT path, CASE WHEN last >= '2024-01-25' THEN 'keep' WHEN row_number() OVER (ORDER BY last >= '2024-01-25', last, path) <= 20 THEN 'probe' ELSE 'wait' END AS action FROM (SELECT '/u/' || user_id AS path, max(strftime(ts, '%Y-%m-%d')) FILTER (WHERE event_type = 'view') AS last FROM events GROUP BY user_id) WHERE last IS NOT NULL""")
def probe_plan(spark, sf):
    e = T(spark, sf, "events").select(F.concat(F.lit("/u/"), "user_id").alias("path"), F.date_format("ts", "yyyy-MM-dd").alias("checked"), "event_type").where("event_type = 'view'")
    return queues.probe_plan(e, e, "2024-01-31", 7, 20)


# ---- history and streaks


@query("""WITH s AS (SELECT DISTINCT user_id AS k, CAST(ts AS DATE) AS day FROM events), w AS (SELECT day, dense_rank() OVER (ORDER BY day) AS i FROM (SELECT DISTINCT day FROM s)) SELECT l.k, strftime(w.day, '%Y-%m-%d') AS day FROM (SELECT k, max(i) AS li FROM s JOIN w USING (day) GROUP BY k) l JOIN w ON w.i = l.li + 1""")
def history_first_missing(spark, sf):
    e = T(spark, sf, "events").select(F.col("user_id").alias("k"), F.date_format("ts", "yyyy-MM-dd").alias("day")).distinct()
    return history.first_missing(e, "k", "day")


@query("""WITH s AS (SELECT DISTINCT user_id AS k, CAST(ts AS DATE) AS day FROM events), w AS (SELECT day, dense_rank() OVER (ORDER BY day) AS i FROM (SELECT DISTINCT day FROM s)), r AS (SELECT k, i FROM s JOIN w USING (day)) SELECT k, strftime(w.day, '%Y-%m-%d') AS day FROM (SELECT k, i + 1 AS i FROM r EXCEPT SELECT k, i FROM r) JOIN w USING (i)""")
def consecutive_diff(spark, sf):
    e = T(spark, sf, "events").select(F.col("user_id").alias("k"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return history.consecutive_losses(e, "k", "day")


@query("""SELECT user_id, coalesce(max(n), 0) AS longest FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN (SELECT user_id, i, count(*) AS n FROM (SELECT user_id, event_type = 'error' AS b, row_number() OVER w - sum(CAST(event_type = 'error' AS INT)) OVER w AS i FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)) WHERE b GROUP BY user_id, i) USING (user_id) GROUP BY user_id""")
def failure_streak(spark, sf):
    return queues.streaks(T(spark, sf, "events"), "user_id", "event_id", F.col("event_type") == "error")


@query("SELECT event_id, count(*) OVER w AS done, CAST(sum(CAST(event_type = 'error' AS INT)) OVER w AS BIGINT) AS failed FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)")
def running_failure_share(spark, sf):
    return queues.running_share(T(spark, sf, "events"), "user_id", "event_id", F.col("event_type") == "error").select("event_id", "done", "failed")


@query("""WITH g AS (SELECT lang || '/' || (doc_id // 4) AS group_id, CAST(doc_id AS VARCHAR) AS page, doc_id AS pos FROM documents) SELECT a.page, b.page AS sibling, a.group_id, b.pos FROM g a JOIN g b ON a.group_id = b.group_id AND a.page <> b.page""")
def siblings(spark, sf):
    g = T(spark, sf, "documents").select(F.concat_ws("/", "lang", F.floor(F.col("doc_id") / 4).cast("string")).alias("group_id"), F.col("doc_id").cast("string").alias("page"), F.col("doc_id").alias("pos"))
    return joins.siblings(g)


@query("""WITH l AS (SELECT page_id AS module, unnest(hs) AS path, generate_subscripts(hs, 1) - 1 AS pos FROM (SELECT page_id, regexp_extract_all(html, 'href="(/[^"]*)"', 1) AS hs FROM pages)), d AS (SELECT *, CASE length(path) % 4 WHEN 0 THEN 'drop' WHEN 1 THEN 'rewrite' WHEN 2 THEN 'keep' END AS d FROM l),
 r AS (SELECT module, pos, CASE WHEN d = 'rewrite' THEN '/r' || substr(path, 1, 3) ELSE path END AS path, CASE WHEN d = 'rewrite' THEN path END AS was FROM d WHERE d IS NULL OR d <> 'drop') SELECT module, CAST(pos AS INT) AS pos, path, was FROM r QUALIFY row_number() OVER (PARTITION BY module, path ORDER BY pos) = 1""")
def apply_link_decisions(spark, sf):
    links = T(spark, sf, "pages").select(F.col("page_id").alias("module"), F.posexplode(F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), 1)).alias("pos", "path"))
    n = F.length("path") % 4
    decisions = links.select("path").distinct().where(n < 3).select("path", F.when(n == 0, "drop").when(n == 1, "rewrite").otherwise("keep").alias("decision"), F.concat(F.lit("/r"), F.substring("path", 1, 3)).alias("to"))
    return build.apply_decisions(links, decisions, "2024-06-01").select("module", "pos", "path", "was")


# ---- gates and reports


@query("SELECT 'orders' AS rule, round(greatest(0, (a - b) * 100.0 / a), 6) AS observed, greatest(0, (a - b) * 100.0 / a) <= 5 AS ok FROM (SELECT count(*) FILTER (WHERE o_orderkey % 10 <> 0) AS a, count(*) FILTER (WHERE o_orderkey % 10 <> 1 AND o_orderkey % 12 <> 0) AS b FROM orders)")
def gate_drop(spark, sf):
    o = T(spark, sf, "orders")
    a, b = o.agg(F.count_if(F.expr(PREV)), F.count_if(F.expr(NEXT + " and o_orderkey % 12 <> 0"))).first()
    return quality.drop_gate(spark, "orders", a, b, 5).select("rule", F.round("observed", 6).alias("observed"), "ok")


@query("SELECT 'errors' AS rule, round(count(*) FILTER (WHERE event_type = 'error') * 100.0 / count(*), 6) AS observed, count(*) FILTER (WHERE event_type = 'error') * 100.0 / count(*) <= 25 AS ok FROM events")
def gate_ratio(spark, sf):
    a, b = T(spark, sf, "events").agg(F.count_if(F.col("event_type") == "error"), F.count("*")).first()
    return quality.ratio_gate(spark, "errors", a, b, 25).select("rule", F.round("observed", 6).alias("observed"), "ok")


@query(f"""SELECT 'exact-duplicates' AS rule, CAST((SELECT count(*) FROM (SELECT url FROM pages GROUP BY url HAVING count(*) > 1)) AS DOUBLE) AS observed UNION ALL SELECT 'alias-duplicates', CAST((SELECT count(*) FROM (SELECT {PATH} FROM pages GROUP BY 1 HAVING count(DISTINCT url) > 1)) AS DOUBLE)""")
def gate_duplicates(spark, sf):
    return quality.duplicates_gate(pages(spark, sf), "url", "path").select("rule", "observed")


@query("""SELECT 'path' AS rule, count(*) FILTER (WHERE NOT coalesce(o_orderkey >= 0, false)) AS failed FROM orders UNION ALL SELECT 'price', count(*) FILTER (WHERE NOT coalesce(o_totalprice > 1000, false)) FROM orders UNION ALL SELECT 'status', count(*) FILTER (WHERE NOT coalesce(o_orderstatus IN ('F', 'O'), false)) FROM orders""")
def contract_checks(spark, sf):
    return quality.contract(T(spark, sf, "orders"), {"path": F.col("o_orderkey") >= 0, "price": F.col("o_totalprice") > 1000, "status": F.col("o_orderstatus").isin("F", "O")})


@query("""SELECT event_type AS family, strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS stamp, round((epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(min(ts)))) / 3600, 1) AS age_hours, round((epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(min(ts)))) / 3600, 1) > 240 AS stale FROM events GROUP BY event_type""")
def freshness(spark, sf):
    e = T(spark, sf, "events").select(F.col("event_type").alias("family"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("stamp"))
    return report.freshness(e, "2024-02-01 00:00:00")


@query(f"SELECT * FROM (WITH c AS ({_CHASE}) SELECT '/p/' || o_orderkey AS link, coalesce(c.state, 'none') AS status, c.\"to\" FROM orders LEFT JOIN c ON c.link = '/p/' || o_orderkey)")
def check_changes(spark, sf):
    """Every order is a link."""
    links = orders(spark, sf).select(F.concat(F.lit("/p/"), "o_orderkey").alias("url"))
    return report.check_links(links, edges(spark, sf)).select("link", "status", "to")


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_events(spark, sf):
    """Extension: the streaming window over the table."""
    from ..streaming.replay import windowed_counts

    out = windowed_counts(T(spark, sf, "events"), "ts", "event_type")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


from . import catalogue_more, catalogue_runs  # noqa: E402, F401  (they register the other queries)
