"""More queries over the driver's tables: column functions, classifiers, winners, queues, gates and building steps.

Inputs are made from keys, in shapes that a key's remainder chooses, so that
the SQL can name the expected value of every row without repeating the engine's
expressions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import EVIDENCE_PRIORITY, Scope
from ..functions import paths as P
from ..functions import scalars as S
from ..functions import text as X
from ..operators import build, classify, dedupe, diff, docs, joins, ledger, quality, queues
from . import report, runs, validate
from .catalogue import EVENT_KIND, NEXT, ORDERS, PREV, QUERIES, SITE, T, _apply, _taxonomy, edges, orders, pages, query

HOST = "site.example"


class _Key:
    """The column of order keys, made where it is used: a column needs a session."""

    def __mod__(self, n):
        return F.col("o_orderkey") % n

    def __getattr__(self, name):
        return getattr(F.col("o_orderkey"), name)


K = _Key()


def cases(by: int, *values, key=None):
    """The value of the key's remainder; texts with {k} take the key in."""
    key = K if key is None else key
    out = F
    for i, v in enumerate(values):
        made = v if not isinstance(v, (str, type(None))) else F.lit(v) if v is None or "{k}" not in v else F.concat(*[F.lit(x) if x != "{k}" else key.cast("string") for x in _parts(v)])
        out = out.when(key % by == i, made)
    return out


def _parts(text: str) -> list[str]:
    pieces = text.split("{k}")
    out = [pieces[0]]
    for p in pieces[1:]:
        out += ["{k}", p]
    return [x for x in out if x]


def sql_cases(by: int, *values: str, key: str = "o_orderkey") -> str:
    return f"CASE {key} % {by} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def O(spark, sf):  # noqa: E743
    return T(spark, sf, "orders")


# ---- paths


@query("""SELECT o_orderkey, '/cloud/' || o_orderkey || '/sub-' || o_orderkey % 7 AS path, '/cloud/' || o_orderkey AS parent, 'cloud' AS first, 'sub-' || o_orderkey % 7 AS last, '/training/modules/m' || o_orderkey AS module,
 'https://site.example/cloud/' || o_orderkey AS absolute, 'https://site.example/en-us/cloud/' || o_orderkey || '/sub-' || o_orderkey % 7 AS probe, 'en-us/Cloud/' || o_orderkey || '/Sub-' || o_orderkey % 7 AS bare, o_orderkey = 7 AS under FROM orders""")
def path_parts(spark, sf):
    u = F.concat(F.lit("https://Site.example/en-us/Cloud/"), "o_orderkey", F.lit("/Sub-"), K % 7, F.lit("/?view=x#f"))
    p = O(spark, sf).withColumn("url", u).withColumn("path", P.canonical_path("url", HOST))
    return p.select("o_orderkey", "path", P.parent_path("path").alias("parent"), P.first_segment("path").alias("first"), P.last_segment("path").alias("last"), P.module_path(F.concat(F.lit("m"), "o_orderkey")).alias("module"), P.absolute(P.parent_path("path"), HOST).alias("absolute"), P.probe_url("url", HOST).alias("probe"), P.bare_path("url").alias("bare"), P.under_prefix("path", "cloud/7").alias("under"))


@query(f"""SELECT o_orderkey, {sql_cases(5, "'/a/' || o_orderkey", "NULL", "'/a/' || o_orderkey", "NULL", "NULL")} AS entry, {sql_cases(5, "'/a/' || o_orderkey", "'https://other.example/a/' || o_orderkey", "'/a/' || o_orderkey", "'/'", "'a/' || o_orderkey")} AS alias FROM orders""")
def entry_paths(spark, sf):
    u = cases(5, "https://site.example/fr-fr/A/{k}/", "https://Other.example/A/{k}", "/en-us/A/{k}?x=1", "https://site.example/en-us/", "A/{k}")
    return O(spark, sf).select("o_orderkey", P.entry_path(u, HOST).alias("entry"), P.alias_key(u, HOST).alias("alias"))


@query(f"""SELECT o_orderkey, {sql_cases(4, "'https://site.example/docs/' || o_orderkey || '?tab=t'", "'https://site.example/docs/' || o_orderkey", "NULL", "NULL")} AS url FROM orders""")
def page_urls(spark, sf):
    loc = cases(4, "https://site.example/EN-US/docs/{k}?view=v1&tab=t#x", "https://site.example/en-us/docs/{k}?view=v2", "https://site.example/fr-fr/docs/{k}", "https://other.example/en-us/docs/{k}")
    return O(spark, sf).select("o_orderkey", P.normal_page_url(loc, HOST).alias("url"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN 'fam-' || o_orderkey END AS family, CASE WHEN o_orderkey % 3 <> 0 THEN CASE WHEN o_orderkey % 3 = 1 THEN 'en-us' ELSE 'fr-fr' END END AS locale, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 3 + 10 AS INT) END AS part FROM orders""")
def sitemap_families(spark, sf):
    loc = cases(3, "https://site.example/_sitemaps/sitemap{k}.xml", "https://site.example/_sitemaps/fam-{k}_en-us_11.xml", "https://site.example/_sitemaps/fam-{k}_fr-fr_12.xml")
    return O(spark, sf).select("o_orderkey", P.sitemap_family(loc).alias("f")).select("o_orderkey", "f.family", "f.locale", "f.part")


@query(f"""SELECT o_orderkey, {sql_cases(3, "'https://docs.example/en/a' || o_orderkey", "'https://docs.example/en/b/' || o_orderkey", "'https://docs.example/en'")} AS url, {sql_cases(3, "'two'", "'one'", "'two'")} AS mapping FROM orders""")
def source_urls(spark, sf):
    path = cases(3, "content/a{k}.md", "content/b/{k}/index.md", "content/index.md")
    return O(spark, sf).select("o_orderkey", P.source_file_url(path, "content", "en", "docs.example").alias("url"), P.first_mapping(path, [("content/b/", "one"), ("content/", "two")]).alias("mapping"))


@query("""SELECT o_orderkey, 'ab-' || o_orderkey AS code, 'ab-' || o_orderkey AS uid_code, '/credentials/certifications/resources/study-guides/ab-' || o_orderkey AS guide, '/credentials/applied-skills/resources/study-guides/ab-' || o_orderkey AS skill_guide, 'a%20b%2F' || o_orderkey || '%3F' AS encoded,
 o_orderkey % 4 < 2 AS is_module, 'https://site.example/x?WT.mc_id=me&k=' || o_orderkey AS link FROM orders""")
def codes_and_links(spark, sf):
    code = P.exam_code(F.concat(F.lit("  AB-"), "o_orderkey", F.lit(" ")))
    path = cases(4, "/training/modules/{k}", "/training/azure/{k}/x", "/training/paths/{k}", "/training/courses/{k}/x")
    link = F.concat(F.lit("https://site.example/en-us/x?WT.mc_id=you&k="), "o_orderkey")
    return O(spark, sf).select("o_orderkey", code.alias("code"), P.exam_code_of_uid(F.concat(F.lit("exam.AB-"), "o_orderkey")).alias("uid_code"), P.study_guide_path(code).alias("guide"), P.study_guide_path(code, True).alias("skill_guide"), P.encoded(F.concat(F.lit("a b/"), "o_orderkey", F.lit("?"))).alias("encoded"), P.is_module_path(path).alias("is_module"), P.normal_link(link, "me").alias("link"))


@query(f"""SELECT o_orderkey, {sql_cases(6, "'/d/a/x' || o_orderkey", "'/d/y' || o_orderkey", "'/abs/z' || o_orderkey", "NULL", "NULL", "'/q/' || o_orderkey")} AS target, {sql_cases(6, "'/d/x' || o_orderkey", "'/y' || o_orderkey", "'/abs/z' || o_orderkey", "NULL", "NULL", "'/q/' || o_orderkey")} AS link, '/d/t' || o_orderkey AS folder FROM orders""")
def resolved_links(spark, sf):
    toc = cases(6, "./x{k}.md", "../Y{k}.yml", "/abs/z{k}/index", "https://other.example/a", "#part", "https://site.example/en-us/q/{k}")
    link = cases(6, "x{k}", "../y{k}?v=1", "/fr-fr/Abs/z{k}/", "https://other.example/a", "#part", "https://site.example/q/{k}#top")
    rel = F.concat(F.lit("../t"), "o_orderkey", F.lit("/toc.json"))
    return O(spark, sf).select("o_orderkey", P.toc_target(toc, F.lit("/d/a"), HOST).alias("target"), P.link_target(link, F.lit("/d/a"), HOST).alias("link"), P.toc_folder(F.lit("/d/a/page"), rel).alias("folder"))


@query(f"""SELECT o_orderkey, {sql_cases(5, "'learn'", "'excluded'", "'index-only'", "NULL", "'learn'")} AS scope, o_orderkey % 5 IN (0, 4) AS inside FROM orders""")
def scopes(spark, sf):
    path = cases(5, "/docs/{k}", "/docs/internal/{k}", "/ref/{k}", "/docsx/{k}", "/docs")
    learn, index = Scope(("/docs",), ("/docs/internal",)), Scope(("/ref",))
    return O(spark, sf).select("o_orderkey", P.scope_for(path, learn, index).alias("scope"), P.in_scope(path, learn).alias("inside"))


# ---- dates, numbers, optional texts


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d') END AS stamp_day, event_id % 3 <> 1 AS is_day, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days, event_id % 3 = 1 OR date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') > 20 AS due,
 CASE WHEN event_id % 3 <> 1 THEN strftime(ts, '%Y-%m-%d') END AS prefix, CASE WHEN event_id % 4 < 2 THEN CASE event_id % 4 WHEN 0 THEN event_type ELSE ' x' END END AS text, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN ' x' WHEN 2 THEN '  ' END AS lastmod FROM events""")
def date_functions(spark, sf):
    e = F.col("event_id")
    day = F.date_format("ts", "yyyy-MM-dd")
    stamp = F.when(e % 3 == 0, F.concat(day, F.lit("T01:02:03Z"))).when(e % 3 == 1, F.lit("2024-02-30")).otherwise(F.concat(day, F.lit(" soon")))
    maybe = F.when(e % 3 == 1, F.lit("2024-02-30")).otherwise(day)
    text = cases(4, F.col("event_type"), " x", "  ", None, key=e)
    return T(spark, sf, "events").select("event_id", S.utc_date("ts").alias("day"), S.date_of_timestamp(stamp).alias("stamp_day"), S.is_iso_date(maybe).alias("is_day"), S.days_between(F.lit("2024-01-01"), day).cast("long").alias("days"), S.refresh_due(maybe, "2024-02-01", 20).alias("due"), S.day_prefix(stamp).alias("prefix"), S.text_or_null(text).alias("text"), S.lastmod_or_null(F.coalesce(text, F.lit("released"))).alias("lastmod"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'docs' ELSE 'learn' END AS family, CASE WHEN o_orderkey % 3 = 0 THEN 'a, b, c, ... (+2 more)' ELSE 'a' END AS listed, CASE WHEN o_orderkey % 4 = 0 THEN 0.0 WHEN o_orderkey % 4 = 1 THEN 25.0 WHEN o_orderkey % 4 = 2 THEN 0.0 ELSE 100.0 END AS dropped,
 CASE o_orderkey % 6 WHEN 0 THEN 'ok' WHEN 1 THEN 'notFound' WHEN 2 THEN 'retry' WHEN 3 THEN 'retry' WHEN 4 THEN 'error' ELSE 'retry' END AS status, sha1('{"v":"' || o_orderpriority || '"}') AS signature, sha1('a' || chr(10) || o_orderpriority) AS lines FROM orders""")
def scalar_functions(spark, sf):
    kind = F.when(K % 2 == 0, "docs").otherwise("unit")
    values = F.when(K % 3 == 0, F.array(*map(F.lit, "abcde"))).otherwise(F.array(F.lit("a")))
    before, after = cases(4, F.lit(0), F.lit(100), F.lit(10), F.lit(5)), cases(4, F.lit(7), F.lit(75), F.lit(20), F.lit(0))
    status = cases(6, F.lit(204), F.lit(410), F.lit(429), F.lit(503), F.lit(403), F.lit(None).cast("int"))
    return O(spark, sf).select("o_orderkey", S.family_of_kind(kind).alias("family"), S.list_some(values).alias("listed"), S.drop_percent(before, after).alias("dropped"), S.status_class(status).alias("status"), S.json_signature("o_orderpriority").alias("signature"), S.sha1_lines(F.lit("a"), F.col("o_orderpriority")).alias("lines"))


# ---- text


@query("""SELECT o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS pos, 'https://site.example/en-us/docs/' || o_orderkey || '?a=1&b=<2>' AS loc, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS lastmod, o_custkey % 2 = 0 AS is_index FROM orders""")
def xml_sitemaps(spark, sf):
    tag = F.when(F.col("o_custkey") % 2 == 0, "sitemap").otherwise("url")
    block = F.concat(F.lit("<"), tag, F.lit("><loc> https://site.example/en-us/docs/"), "o_orderkey", F.lit("?a=1&amp;b=&lt;2&gt;\n</loc>"), F.when(K % 2 == 0, F.concat(F.lit("<lastmod>"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</lastmod>"))).otherwise(""), F.lit("</"), tag, F.lit(">"))
    files = O(spark, sf).groupBy("o_custkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", block.alias("b")))), lambda x: x.b), "<url></url>").alias("b"))
    files = files.withColumn("xml", F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("<sitemapindex >"), "b", F.lit("</sitemapindex>"))).otherwise(F.concat(F.lit("<urlset>"), "b", F.lit("</urlset>"))))
    found = F.when(X.is_sitemap_index("xml"), X.sitemap_index("xml")).otherwise(X.urlset("xml"))
    return files.select("o_custkey", X.is_sitemap_index("xml").alias("is_index"), F.posexplode(found).alias("pos", "f")).select("o_custkey", "pos", "f.loc", "f.lastmod", "is_index")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN 'Order & ' || o_orderkey END AS title, CASE WHEN o_orderkey % 4 <> 3 THEN 'p' || o_orderkey % 5 END AS product, CASE WHEN o_orderkey % 4 <> 3 AND o_orderkey % 2 = 1 THEN 'sub' END AS subproduct, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderpriority END AS description, o_orderkey % 3 = 0 AS noindex, 'p' || o_orderkey % 5 AS meta FROM orders""")
def head_records(spark, sf):
    title = F.when(K % 4 == 3, F.lit(" | Site")).otherwise(F.concat(F.lit("Order &amp; "), "o_orderkey", F.lit(" | Learn | Site")))
    html = F.concat(
        F.lit("<html><head><title>"), title, F.lit("</title>\n<META name='ms.prod' content='p"), K % 5, F.lit("'><meta content=\""), "o_orderpriority", F.lit('" name="description">'),
        F.when(K % 2 == 1, F.lit('<meta name="ms.subservice" content="sub"/>')).otherwise(""), F.when(K % 3 == 0, F.lit('<meta name="ROBOTS" content="noarchive, NoIndex">')).otherwise(F.lit('<meta name="robots" content="index">')),
        F.lit('<meta name="ms.prod" content="second"></head><body><meta name="ms.technology" content="body"></body></html>'),
    )
    rows = O(spark, sf).withColumn("html", html).withColumn("m", X.head_meta("html"))
    r = X.record_from_head(F.regexp_replace(X.page_title("html"), r" \| Learn", ""), "m")
    return rows.select("o_orderkey", r.alias("r"), X.is_noindex("m").alias("noindex"), X.meta_content("html", "ms.prod").alias("meta")).select("o_orderkey", "r.*", "noindex", "meta")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN 'T ' || o_orderkey END AS title, CASE WHEN o_orderkey % 3 <> 2 THEN 'second: ' || o_orderpriority END AS product, 'A ' || o_orderkey AS plain FROM orders""")
def frontmatter_records(spark, sf):
    body = F.concat(F.lit("title: \"T "), "o_orderkey", F.lit("\"\nproduct: first\n# note\nproduct: 'second: "), "o_orderpriority", F.lit("'\n---\nbody: no\n---\n"))
    md = cases(3, F.concat(F.lit("---\n"), body), F.concat(F.lit("﻿---\r\n"), body), F.concat(F.lit("text\n---\n"), body))
    f = X.frontmatter("md")
    plain = X.without_templates(F.concat(F.lit("A {% raw\n%}{{ x }} "), "o_orderkey", F.lit(" {{y}}")))
    return O(spark, sf).withColumn("md", md).select("o_orderkey", F.try_element_at(f, F.lit("title")).alias("title"), F.try_element_at(f, F.lit("product")).alias("product"), plain.alias("plain"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN ' <p>' || o_orderpriority || '</p>' END AS content, CASE WHEN o_orderkey % 3 = 0 THEN 'apl-' || (1000 + o_orderkey % 9000) END AS code, CASE WHEN o_orderkey % 5 <> 4 THEN o_orderpriority END AS text FROM orders""")
def unit_pages(spark, sf):
    code = F.concat(F.lit("APL-"), 1000 + K % 9000)
    html = F.concat(F.lit('<x id="start"> <script>var a = "<p>";</script><p>'), "o_orderpriority", F.lit("</p><STYLE>p{}</STYLE >"), F.when(K % 5 == 4, "").otherwise(F.lit('<x id="end">')), cases(3, F.concat(code, F.lit(" "), F.lower(code)), F.concat(code, F.lit(" APL-0000")), F.lit("none")))
    content = X.unit_content("html", '<x id="start">', '<x id="end">')
    return O(spark, sf).withColumn("html", html).select("o_orderkey", content.alias("content"), X.only_code("html").alias("code"), X.text_of(content).alias("text"))


@query(f"""SELECT o_orderkey, {sql_cases(7, "'ok'", "'misaligned'", "'bad-shape'", "'bad-shape'", "'bad-shape'", "'not-found'", "'transient'")} AS outcome, {sql_cases(7, "'/m/a/1,/m/a/2'", *["NULL"] * 6)} AS urls FROM orders""")
def hierarchies(spark, sf):
    units = lambda *u: '{"units":[' + ",".join('{"uid":"%s","url":"%s"}' % x for x in u) + "]}"
    body = cases(7, units(("u1", "https://site.example/en-us/m/a/1"), ("u2", "/M/a/2/")), units(("u2", "/m/a/1"), ("u1", "/m/a/2")), units(("u1", "/m/b/1"), ("u2", "/m/a/2")), '{"units":[]}', "not json", '{"ErrorCode":"ModuleIdNotFound"}', "")
    status = cases(7, *[F.lit(200)] * 5, F.lit(404), F.lit(503))
    h = X.hierarchy("body", F.lit("/m/a"), F.array(F.lit("u1"), F.lit("u2")), HOST)
    rows = O(spark, sf).withColumn("body", body).withColumn("h", h)
    return rows.select("o_orderkey", classify.classify_hierarchy(status, X.is_error_code("body", "ModuleIdNotFound"), F.col("h.outcome"), F.lit(False)).alias("outcome"), F.array_join("h.urls", ",").alias("urls"))


@query("""SELECT o_orderkey, CAST(0 AS INT) AS pos, NULL AS section, 'https://a/' || o_orderkey AS href, 'One' AS text FROM orders UNION ALL SELECT o_orderkey, 100000, 'part ' || o_orderpriority, '/two', 'Two & more' FROM orders UNION ALL SELECT o_orderkey, 100002, 'part ' || o_orderpriority, '/three', 'Three' FROM orders""")
def section_links(spark, sf):
    html = F.concat(F.lit('<p><a class="x" href="https://a/'), "o_orderkey", F.lit('">One</a></p><H2 id="s">part <b>'), "o_orderpriority", F.lit('</b></H2><a href="/two">Two &amp; <i>more</i></a><A href="/two">again</A ><a href=\'/three\'>Three</a><h2>In this article</h2><a href="/no">No</a>'))
    return X.page_links(O(spark, sf).select("o_orderkey", html.alias("html")), "html", "o_orderkey")


@query("""SELECT path, pos, section, target, text FROM (SELECT '/docs/' || o_orderkey AS path, CAST(0 AS INT) AS pos, 'lead' AS section, '/docs/next' || o_orderkey AS target, 'Next' AS text FROM orders UNION ALL SELECT '/docs/' || o_orderkey, 100000, o_orderpriority, '/docs/next' || o_orderkey, 'Again' FROM orders UNION ALL SELECT '/docs/' || o_orderkey, 100002, o_orderpriority, '/other', 'Other' FROM orders) WHERE CAST(substr(path, 7) AS BIGINT) % 9 <> 3""")
def article_links(spark, sf):
    links = F.concat(F.lit('<a href="../docs/next'), "o_orderkey", F.lit('#x" data-linktype="relative-path">Next</a><a href="https://else.example/">E</a><a href="#a" data-linktype="self-bookmark">B</a><a href="/docs/'), "o_orderkey", F.lit('">Self</a><h2>'), "o_orderpriority", F.lit('</h2><a href="https://site.example/en-us/docs/Next'), "o_orderkey", F.lit('/">Again</a><a href="/x" data-linktype="external">X</a><a href="/other?b">Other</a><a href="/z"> </a><a href="/other">Second</a>'))
    html = F.concat(F.lit('<h1>T</h1>'), links, F.when(K % 9 == 3, "").otherwise(F.lit("</main>")))
    rows = O(spark, sf).select(F.concat(F.lit("/docs/"), "o_orderkey").alias("path"), F.concat(F.lit('<a href="/before">B</a>'), html).alias("html"))
    return X.article_links(rows, "html", "path", HOST)


# ---- classifiers


@query(f"""SELECT o_orderkey, {sql_cases(5, "'module'", "'unit'", "'learning-path'", "'docs'", "'module'")} AS shape, {sql_cases(5, "'verified'", "'absent'", "'redirected'", "'transient'", "'transient'")} AS expected, {sql_cases(5, "'live'", "'gone'", "'live'", "'transient'", "'transient'")} AS external FROM orders""")
def page_classes(spark, sf):
    path = cases(5, "/training/modules/{k}", "/training/modules/{k}/1-a", "/training/paths/{k}", "/cloud/{k}", "/training/azure/{k}")
    status, final = cases(5, F.lit(200), F.lit(404), F.lit(200), F.lit(503), F.lit(200)), cases(5, "/g/{k}", "/g/{k}", "/h", "/g/{k}", None)
    shape = classify.shape_of(path, K % 5 == 4, F.lit(False))
    return O(spark, sf).select("o_orderkey", shape.alias("shape"), classify.classify_expected(status, final, F.concat(F.lit("/g/"), "o_orderkey"), F.lit(False)).alias("expected"), classify.external_page(status, K % 5 == 4).alias("external"))


@query(f"""SELECT o_orderkey, {sql_cases(9, "'ok'", "'moved'", "'broken'", "'unknown'", "'broken'", "'broken'", "'ok'", "'broken'", "'broken'")} AS verdict, {sql_cases(9, "NULL", "'/training/modules/n' || o_orderkey", "NULL", "NULL", "NULL", "'/cloud/x'", "NULL", "NULL", "NULL")} AS redirects_to FROM orders""")
def live_verdicts(spark, sf):
    path = cases(9, "/training/modules/m{k}", "/training/modules/m{k}", "/training/modules/m{k}", "/training/modules/m{k}", "/training/modules/m{k}", "/training/modules/m{k}", "/credentials/certifications/exams/e{k}", "/credentials/certifications/resources/study-guides/s{k}", "/training/modules/m{k}")
    final = cases(9, "/training/modules/m{k}", "/training/modules/n{k}", "/training/modules/m{k}", "/training/modules/m{k}", "/training/modules/m{k}", "/cloud/x", "/credentials/certifications/c{k}", "/credentials/certifications/c{k}", "/training/browse")
    status, title = cases(9, F.lit(200), F.lit(200), F.lit(404), F.lit(500), *[F.lit(200)] * 5), F.when(K % 9 == 4, "404 - Content not found").otherwise("Fine")
    v = classify.interpret_probe(path, status, final, title)
    return O(spark, sf).select("o_orderkey", v.verdict.alias("verdict"), v.redirects_to.alias("redirects_to"))


@query(f"""SELECT o_orderkey, {sql_cases(5, "'training'", "'docs'", "'learn-other'", "'external'", "NULL")} AS kind, {sql_cases(5, "'/training/modules/' || o_orderkey", "'/cloud/' || o_orderkey", "'/answers/' || o_orderkey", "NULL", "NULL")} AS path, {sql_cases(5, *["NULL"] * 3, "'https://other.example/' || o_orderkey || '?a'", "NULL")} AS url, {sql_cases(5, "'keep'", "'rewrite'", "NULL", "NULL", "NULL")} AS offline, {sql_cases(5, "'keep'", "'rewrite'", "'drop'", "'unverified'", "'drop'")} AS probed FROM orders""")
def link_decisions(spark, sf):
    href = cases(5, "https://site.example/en-us/training/modules/{k}/", "/cloud/{k}?x", "https://site.example/answers/{k}", "https://other.example/{k}?a#b", "mailto:a@{k}")
    link = classify.classify_link(href, F.concat(F.lit("/training/modules/"), F.col("o_orderkey") + 1), HOST)
    cached, sure = cases(5, "valid", "moved", "broken", "broken", "unverifiable"), F.when(K % 5 == 3, "low").otherwise("high")
    live, to = cases(5, "ok", "moved", "broken", "unknown", "moved"), F.when(K % 5 == 1, F.concat(F.lit("/cloud/new/"), "o_orderkey"))
    return O(spark, sf).select("o_orderkey", link.kind.alias("kind"), link.path.alias("path"), link.url.alias("url"), classify.decide_offline(link.path, cached, to, sure).alias("offline"), classify.decide_probe(link.path, live, to).alias("probed"))


# ---- winners


def _entries(spark, sf):
    """Two or three entries a customer, not all of them well formed."""
    none = F.lit(None).cast("string")
    return O(spark, sf).select(
        F.lit("removed").alias("file"), F.concat(F.lit("https://site.example/en-us/Docs/"), "o_custkey", F.lit("/")).alias("path"), F.when(K % 10 == 0, "thing").otherwise("docs").alias("kind"), F.lit("docs").alias("family"),
        F.when(K % 10 == 1, "moved").otherwise("gone").alias("outcome"), none.alias("to"), F.concat(F.lit("t"), "o_orderkey").alias("title"), none.alias("parent"), F.when(K % 10 == 2, "2024-13-01").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("firstSeen"),
        F.when(K % 10 == 3, "never").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("lastVerified"), F.when(K % 10 == 4, "rumour").otherwise("quarantine").alias("evidence"), F.lit(404).alias("status"), "o_orderkey",
    )


@query(f"""SELECT o_orderkey, '/docs/' || o_custkey AS path, {sql_cases(10, "'kind'", "'outcome'", "'firstSeen'", "NULL", "'evidence'", *["NULL"] * 5)} AS problem, CASE WHEN o_orderkey % 10 <> 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS "lastVerified" FROM orders""")
def entry_problems(spark, sf):
    return ledger.checked_entries(_entries(spark, sf), HOST).select("o_orderkey", "path", "problem", "lastVerified")


@query("""WITH e AS (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS f, CASE WHEN o_orderkey % 10 <> 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS v FROM orders WHERE o_orderkey % 10 NOT IN (0, 1, 2, 4)),
 w AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY v DESC NULLS LAST, f, 't' || o_orderkey) AS n, min(f) OVER (PARTITION BY o_custkey) AS least FROM e) SELECT '/docs/' || o_custkey AS path, 't' || o_orderkey AS title, least AS "firstSeen", v AS "lastVerified" FROM w WHERE n = 1""")
def preferred_entries(spark, sf):
    return ledger.normal_ledger(_entries(spark, sf).drop("o_orderkey"), HOST).select("path", "title", "firstSeen", "lastVerified")


@query("""SELECT path, url FROM (SELECT '/c/' || o_custkey AS path, '/c/' || o_custkey || '?' || o_orderkey AS url, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END, CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END DESC NULLS LAST, CASE WHEN o_orderkey % 2 = 0 THEN '2024-01-01' END DESC NULLS LAST, '/c/' || o_custkey || '?' || o_orderkey) AS n FROM orders) WHERE n = 1""")
def catalogue_winners(spark, sf):
    path = F.concat(F.lit("/c/"), "o_custkey")
    rows = O(spark, sf).select(path.alias("path"), F.concat(path, F.lit("?"), "o_orderkey").alias("url"), F.when(K % 5 != 0, "title").alias("title"), F.when(K % 3 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("lastmod"), F.when(K % 2 == 0, "2024-01-01").alias("checked"))
    return dedupe.pick_record(rows, "path").select("path", "url")


@query("""SELECT url, k FROM (SELECT '/c/' || o_custkey AS url, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y-%m') END DESC NULLS LAST, o_orderkey) AS n FROM orders) WHERE n = 1""")
def newest_urls(spark, sf):
    rows = O(spark, sf).select(F.concat(F.lit("/c/"), "o_custkey").alias("url"), F.when(K % 3 != 0, F.date_format("o_orderdate", "yyyy-MM")).alias("lastmod"), K.alias("k"))
    return dedupe.newest_per_url(rows, "k").select("url", "k")


def _evidence(spark, sf):
    none = F.lit(None).cast("string")
    names = list(EVIDENCE_PRIORITY)
    return O(spark, sf).select(F.concat(F.lit("/training/modules/c"), "o_custkey").alias("path"), F.lit("module").alias("kind"), none.alias("parent"), F.concat(F.lit("t"), "o_orderkey").alias("title"), cases(len(names), *names).alias("evidence"), F.lit("2024-01-01").alias("firstSeen"), "o_custkey", "o_orderkey")


@query("""SELECT path, title FROM (SELECT '/training/modules/c' || o_custkey AS path, 't' || o_orderkey AS title, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 8, 't' || o_orderkey) AS n FROM orders) WHERE n = 1""")
def strongest_evidence(spark, sf):
    return dedupe.strongest_candidate(_evidence(spark, sf), EVIDENCE_PRIORITY).select("path", "title")


@query("""SELECT path, title FROM (SELECT '/training/modules/c' || o_custkey AS path, 't' || o_orderkey AS title, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus <> 'F', 't' || o_orderkey) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')) WHERE n = 1""")
def candidate_sources(spark, sf):
    e = _evidence(spark, sf).join(O(spark, sf).select("o_orderkey", "o_orderstatus"), "o_orderkey").drop("o_custkey", "o_orderkey")
    of = lambda segment: T(spark, sf, "customer").where(F.col("c_mktsegment") == segment).select(F.concat(F.lit("/training/modules/c"), "c_custkey").alias("path"))
    return ledger.merged_candidates([e.where("o_orderstatus = 'F'"), e.where("coalesce(o_orderstatus, '') <> 'F'")], of("BUILDING"), of("MACHINERY")).select("path", "title")


@query("""SELECT '/c/' || c_custkey AS path, CASE WHEN o.k IS NOT NULL THEN 'order' ELSE 'customer' END AS source FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o ON k = c_custkey UNION ALL SELECT DISTINCT '/c/' || o_custkey, 'order' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def last_sources(spark, sf):
    c = T(spark, sf, "customer").select(F.concat(F.lit("/c/"), "c_custkey").alias("path"), F.lit("customer").alias("source"))
    return dedupe.last_per_path(c, O(spark, sf).select(F.concat(F.lit("/c/"), "o_custkey").alias("path"), F.lit("order").alias("source")).distinct())


@query("""SELECT l_orderkey, bool_and(ok) AS rising FROM (SELECT l_orderkey, coalesce(l_partkey > lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey), true) AS ok FROM lineitem) GROUP BY l_orderkey""")
def rising_lists(spark, sf):
    li = T(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda x: x.l_partkey).alias("v"))
    return li.select("l_orderkey", dedupe.is_sorted_unique(F.col("v")).alias("rising"))


@query("""SELECT "from", "to", status FROM (SELECT '/r/' || o_custkey AS "from", '/t/' || o_orderkey AS "to", CAST(300 + o_orderkey % 9 AS INT) AS status, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CASE o_orderkey % 4 WHEN 0 THEN 'moved' WHEN 1 THEN 'landing' ELSE 'retired' END, '/t/' || o_orderkey) AS n FROM orders WHERE o_orderkey % 4 <> 3) WHERE n = 1""")
def redirect_winners(spark, sf):
    rows = O(spark, sf).select(F.concat(F.lit("https://site.example/R/"), "o_custkey").alias("from"), F.concat(F.lit("/en-us/t/"), "o_orderkey").alias("to"), cases(4, "moved", "landing", "retired", "odd").alias("kind"), (300 + K % 9).cast("int").alias("status"), F.lit("2024-01-01").alias("firstSeen"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("lastSeen"))
    return ledger.normal_redirects(rows, HOST).select("from", "to", "status")


@query(f"""WITH r AS (SELECT '/p/' || o_orderkey AS path, day, o_orderkey FROM {ORDERS}), d AS (SELECT path, CASE WHEN o_orderkey % 3 = 0 THEN 'landing' ELSE 'moved' END AS outcome, 'docs-redirect' AS evidence, day AS v, 1 AS o FROM r WHERE o_orderkey % 2 = 0), q AS (SELECT path, 'gone' AS outcome, 'quarantine' AS evidence, '1995-06-01' AS v, 0 AS o FROM r WHERE o_orderkey % 5 = 0)
 SELECT path, outcome, evidence, CASE WHEN outcome = 'moved' THEN 'moved' ELSE 'removed' END AS file FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY v DESC, o) AS n FROM (SELECT * FROM d UNION ALL SELECT * FROM q)) WHERE n = 1""")
def docs_entries(spark, sf):
    o = orders(spark, sf).withColumn("path", F.concat(F.lit("/p/"), "o_orderkey"))
    r = o.where("o_orderkey % 2 = 0").select(F.col("path").alias("from"), F.lit("/t").alias("to"), F.when(K % 3 == 0, "landing").otherwise("moved").alias("kind"), F.lit(301).alias("status"), F.col("day").alias("firstSeen"), F.col("day").alias("lastSeen"))
    q = o.where("o_orderkey % 5 = 0").select("path", "title", F.lit(404).alias("status"), F.col("day").alias("firstDetected"), F.lit("1995-06-01").alias("lastChecked"))
    return ledger.docs_entries(r, q, "2024-06-01").select("path", "outcome", "evidence", "file")


@query(f"""WITH a AS (SELECT path, o_orderkey % 4 AS x FROM {ORDERS} WHERE {PREV}), b AS (SELECT path, CASE WHEN o_orderkey % 3 = 0 THEN 9 ELSE o_orderkey % 4 END AS x FROM {ORDERS} WHERE {NEXT}) SELECT CASE WHEN a.path IS NULL THEN 'added:' || b.x WHEN b.path IS NULL THEN 'dropped' WHEN a.x <> b.x THEN 'reclassified' ELSE 'kept' END AS change, count(*) AS n FROM a FULL JOIN b ON a.path = b.path GROUP BY 1""")
def ledger_compared(spark, sf):
    o = orders(spark, sf)
    a, b = o.where(PREV).select("path", (K % 4).cast("string").alias("outcome")), o.where(NEXT).select("path", F.when(K % 3 == 0, "9").otherwise((K % 4).cast("string")).alias("outcome"))
    return ledger.compared(a, b)


@query("""SELECT path, outcome FROM (SELECT o_orderkey, path, CASE WHEN told THEN CASE WHEN o_orderkey % 2 = 0 THEN 'moved' ELSE 'gone' END ELSE 'unverified' END AS outcome FROM (SELECT o_orderkey, '/training/modules/m' || o_orderkey AS path, o_orderkey % 3 = 0 AND o_orderkey % 9 <> 0 AS told FROM orders WHERE o_orderkey % 4 IN (0, 1) AND o_orderkey % 25 <> 0)) WHERE NOT (outcome = 'unverified' AND o_orderkey % 8 = 1)""")
def confirmed_only(spark, sf):
    o = orders(spark, sf)
    return ledger.without_unconfirmed(_apply(spark, sf), o.where("o_orderkey % 8 in (0, 1)"), o.where("o_orderkey % 4 = 0")).select("path", "outcome")


# ---- differences


@query(f"""WITH t AS (SELECT path, 'tombstone' AS evidence, 1 AS p FROM {ORDERS} WHERE o_orderkey % 10 = 1 AND o_orderkey % 4 <> 0), n AS (SELECT path, 'hierarchy-not-found', 2 FROM {ORDERS} WHERE {NEXT} AND o_orderkey % 6 = 0), r AS (SELECT path, 'rename', 4 FROM {ORDERS} WHERE {PREV} AND {NEXT} AND o_orderkey % 7 = 0)
 SELECT CASE WHEN o_orderkey % 7 = 0 AND evidence = 'hierarchy-not-found' THEN path || '-v2' ELSE path END AS path, evidence FROM (SELECT x.*, CAST(substr(path, 20) AS BIGINT) AS o_orderkey FROM (SELECT * FROM t UNION ALL SELECT * FROM n UNION ALL SELECT * FROM r) x)""")
def module_candidates(spark, sf):
    o = orders(spark, sf)
    now = o.where(NEXT).select("uid", F.when(K % 7 == 0, F.concat("path", F.lit("-v2"))).otherwise(F.col("path")).alias("path"), "title", (K % 6 == 0).alias("hierarchyNotFound"))
    removed = o.where("o_orderkey % 10 = 1").select("uid", "path", "title", F.lit("2024-06-01").alias("removedOn"))
    return diff.diff_modules(removed.where("uid % 4 = 0"), now, removed, o.where(PREV).select("uid", "path"), "2024-06-01").select("path", "evidence")


@query(f"""SELECT kind, path, evidence FROM (SELECT CASE o_orderkey % 2 WHEN 0 THEN 'course' ELSE 'exam' END AS kind, path, 'tombstone' AS evidence FROM {ORDERS} WHERE o_orderkey % 10 = 1 UNION ALL SELECT CASE o_orderkey % 2 WHEN 0 THEN 'course' ELSE 'exam' END, path, 'rename' FROM {ORDERS} WHERE {PREV} AND {NEXT} AND o_orderkey % 7 = 0
 UNION ALL SELECT 'study-guide', '/guide/' || o_orderkey, 'live-probe' FROM {ORDERS} WHERE {PREV} AND {NEXT} AND o_orderkey % 3 = 0 AND o_orderkey % 2 = 0)""")
def content_candidates(spark, sf):
    o = orders(spark, sf).withColumn("type", F.when(K % 2 == 0, "course").otherwise("exam"))
    old = o.where(PREV).select("type", "uid", "path", "title", F.when(K % 3 == 0, F.concat(F.lit("/guide/"), "o_orderkey")).alias("studyGuide"))
    new = o.where(NEXT).select("type", "uid", F.when(K % 7 == 0, F.concat("path", F.lit("-v2"))).otherwise(F.col("path")).alias("path"), "title", F.lit(None).cast("string").alias("studyGuide"), (K % 2 == 0).alias("guideKnown"))
    gone = diff.tombstones(old, old.limit(0).select("type", "uid", "path", "title", F.lit("x").alias("lastSeen"), F.lit("x").alias("removedOn")), new, ["type", "uid"], "2024-06-01")
    return diff.diff_content(old, new, gone.limit(0), gone, "2024-06-01").select("kind", "path", "evidence")


@query(f"SELECT uid, path FROM {ORDERS} WHERE o_orderkey % 10 = 1 AND o_orderkey % 3 = 0")
def tombstone_collisions(spark, sf):
    o = orders(spark, sf)
    return diff.collisions(o.where("o_orderkey % 10 = 1").select("uid", "path"), o.where("o_orderkey % 3 = 0"))


# ---- queues


@query("""SELECT doc_id, row_number() OVER (ORDER BY CASE WHEN doc_id % 4 <> 0 THEN '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') END DESC NULLS LAST, '/d/' || doc_id) AS pos FROM documents""")
def queue_order(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", F.concat(F.lit("/d/"), "doc_id").alias("path"), F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"))).alias("lastmod"))
    from pyspark.sql import Window

    return queues.order_queue(d).select("doc_id", F.row_number().over(Window.orderBy(F.desc_nulls_last("lastmod"), F.asc("path"))).cast("long").alias("pos"))


@query("""WITH f AS (SELECT s_suppkey AS k, 'f' || s_suppkey AS family FROM supplier), m AS (SELECT *, CASE WHEN k % 5 = 0 THEN 'unknown' WHEN k % 5 = 1 THEN 'scope-changed' WHEN k % 5 = 2 THEN 'relevant' WHEN k % 7 < 3 THEN 'recheck' END AS reason, '2024-01-0' || (k % 7 + 1) AS checked FROM f)
 SELECT family, reason FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY checked, family) AS n FROM m WHERE reason IS NOT NULL) WHERE reason <> 'recheck' OR n <= 3""")
def sitemap_choice(spark, sf):
    k = F.col("s_suppkey")
    f = T(spark, sf, "supplier").select(F.concat(F.lit("f"), "s_suppkey").alias("family"), "s_suppkey")
    memo = f.where("s_suppkey % 5 <> 0").select("family", (k % 5 == 2).alias("relevant"), F.concat(F.lit("2024-01-0"), k % 7 + 1).alias("checked"), F.when(k % 5 == 1, "old").otherwise("sig").alias("scope"))
    return queues.sitemap_plan(f, memo, "sig", "2024-01-31", 28, 3)


@query("""SELECT segment, n FROM (SELECT split_part(p_name, ' ', 1) AS segment, count(*) AS n FROM part WHERE p_size > 10 GROUP BY 1) ORDER BY n DESC, segment LIMIT 20""")
def unscoped_segments(spark, sf):
    return queues.unscoped_segments(T(spark, sf, "part").select(F.split("p_name", " ")[0].alias("segment"), "p_size"), F.coalesce(F.col("p_size") <= 10, F.lit(True)), 20)


@query()
def drawn_sample(spark, sf):
    return queues.sample(T(spark, sf, "part").select("p_partkey"), 100, 5)


@query("""WITH a AS (SELECT path, o_orderkey, CASE WHEN told THEN CASE WHEN o_orderkey % 2 = 0 THEN 'moved' ELSE 'gone' END ELSE 'unverified' END AS outcome, CASE WHEN o_orderkey % 4 = 0 THEN day ELSE '2023-06-01' END AS f, CASE WHEN told THEN '2024-06-02' END AS v
 FROM (SELECT o_orderkey, '/training/modules/m' || o_orderkey AS path, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 3 = 0 AND o_orderkey % 9 <> 0 AS told FROM orders WHERE o_orderkey % 4 IN (0, 1) AND o_orderkey % 25 <> 0)),
 t AS (SELECT *, CASE WHEN outcome = 'unverified' THEN 1 ELSE 3 END AS tier FROM a), r AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY CASE tier WHEN 1 THEN f ELSE v END, path) AS n FROM t)
 SELECT path, CASE tier WHEN 1 THEN 'unverified' ELSE 'reverify' END AS reason, row_number() OVER (ORDER BY tier, CASE tier WHEN 1 THEN f ELSE v END, path) AS queue_pos FROM r WHERE tier = 1 OR n <= 50 QUALIFY queue_pos <= 900""")
def ledger_queue(spark, sf):
    return queues.verification_queue(_apply(spark, sf), "2024-06-03", 900, 50).select("path", "reason", "queue_pos")


# ---- gates


@query("""WITH n AS (SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM customer) AS b) SELECT 'floor' AS rule, CAST(a AS DOUBLE) AS observed, a >= b AS ok FROM n UNION ALL SELECT 'kept', round(b * 100.0 / a, 6), b * 100.0 / a >= 5 FROM n UNION ALL SELECT 'index-size', CAST(b AS DOUBLE), b >= ceil(a * 0.85) FROM n
 UNION ALL SELECT 'content:' || o_orderstatus, CAST(count(*) FILTER (WHERE o_orderkey % 10 <> 1) AS DOUBLE), count(*) FILTER (WHERE o_orderkey % 10 <> 1) >= CASE o_orderstatus WHEN 'P' THEN 1000000 ELSE 0 END AND (count(*) - count(*) FILTER (WHERE o_orderkey % 10 <> 1)) * 100.0 / count(*) <= 20 FROM orders GROUP BY o_orderstatus""")
def more_gates(spark, sf):
    o, a, b = O(spark, sf), O(spark, sf).count(), T(spark, sf, "customer").count()
    of = lambda df: df.groupBy(F.col("o_orderstatus").alias("type")).agg(F.count("*").alias("n"))
    gates = [quality.floor_gate(spark, "floor", a, b), quality.kept_gate(spark, "kept", a, b, 5), quality.index_gate(spark, b, quality.index_baseline(a, 1)), quality.content_gates(of(o), of(o.where(NEXT)), 20, {"P": 1_000_000})]
    out = gates[0]
    for g in gates[1:]:
        out = out.unionByName(g)
    return out.select("rule", F.round("observed", 6).alias("observed"), "ok")


@query("SELECT 'n' || n_nationkey AS id FROM nation WHERE n_nationkey % 3 = 0 AND EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey)")
def recovered_categories(spark, sf):
    n = T(spark, sf, "nation").where("n_nationkey % 3 = 0").select(F.concat(F.lit("n"), "n_nationkey").alias("id"))
    return quality.recovered(n, T(spark, sf, "supplier").groupBy(F.concat(F.lit("n"), "s_nationkey").alias("id")).agg(F.count("*").alias("n")))


@query("""SELECT event_type || ': refreshed ' || round((epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(min(ts)))) / 3600, 1) || ' hours ago' AS warning FROM events GROUP BY event_type HAVING round((epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(min(ts)))) / 3600, 1) > 240 UNION ALL SELECT 'none: never refreshed'""")
def stale_warnings(spark, sf):
    e = T(spark, sf, "events").select(F.col("event_type").alias("family"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("stamp"))
    none = spark.createDataFrame([("none", None)], "family string, stamp string")
    return report.freshness_warnings(report.freshness(e.unionByName(none), "2024-02-01 00:00:00"))


# ---- building


@query("""SELECT 'r' || r_regionkey AS id, r_name AS name, 'r' || r_regionkey AS "top" FROM region UNION ALL SELECT 'n' || n_nationkey, n_name, 'r' || n_regionkey FROM nation UNION ALL SELECT 'x' || s_nationkey, 'custom', 'x' || s_nationkey FROM supplier GROUP BY s_nationkey""")
def custom_taxonomy(spark, sf):
    t = build.flatten_taxonomy(_taxonomy(spark, sf))
    some = T(spark, sf, "supplier").select("s_nationkey").distinct()
    named = lambda prefix: some.select(F.concat(F.lit(prefix), "s_nationkey").alias("id"), F.lit("custom").alias("name"), F.concat(F.lit(prefix), "s_nationkey").alias("top"))
    return build.with_custom(t, named("x").unionByName(named("n")))


@query("""SELECT l_orderkey, string_agg(CASE WHEN p_size % 3 <> 0 THEN p_name ELSE CAST(l_partkey AS VARCHAR) END, '|' ORDER BY l_linenumber, l_partkey, l_suppkey) AS names FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""")
def titles_or_keys(spark, sf):
    li = T(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda x: x.l_partkey.cast("string")).alias("ids"))
    names = T(spark, sf, "part").where("p_size % 3 <> 0").select(F.col("p_partkey").cast("string").alias("p_partkey"), "p_name")
    return joins.ordered_lookup(li, "l_orderkey", "ids", names, "p_partkey", "p_name", fallback=True).select("l_orderkey", F.array_join("names", "|").alias("names"))


@query(f"""SELECT uid, CASE WHEN o_orderkey % 5 = 0 THEN '/new/' || o_orderkey WHEN o_orderkey % 5 IN (1, 2) THEN NULL WHEN o_orderkey % 2 = 0 THEN '/old/' || o_orderkey END AS guide, o_orderkey % 5 IN (0, 1, 2) AS known FROM {ORDERS}""")
def study_guides(spark, sf):
    o = orders(spark, sf)
    probes = o.where("o_orderkey % 5 <> 4").select("uid", F.concat(F.lit("/new/"), "o_orderkey").alias("path"), cases(5, "verified", "absent", "redirected", "transient", None).alias("outcome"))
    out = build.apply_guide_probes(o.select("uid", "title"), o.where("o_orderkey % 2 = 0").select("uid", F.concat(F.lit("/old/"), "o_orderkey").alias("studyGuide")), probes)
    return out.select("uid", F.col("studyGuide").alias("guide"), F.col("guideKnown").alias("known"))


def _modules(spark, sf):
    o = orders(spark, sf)
    now = o.select("uid", "path", F.array(F.lit("u1"), F.lit("u2")).alias("units"), F.when(K % 5 == 2, "new").otherwise("sig").alias("unitSig"), F.concat("path", F.when(K % 5 == 4, F.lit("/1-z")).otherwise(F.lit("/1-a"))).alias("firstUnitPath"))
    urls = F.when(K % 5 == 1, F.lit(None)).when(K % 5 == 3, F.array(F.concat("path", F.lit("/1-a")))).otherwise(F.array(F.concat("path", F.lit("/1-a")), F.concat("path", F.lit("/2-b"))))
    return now, o.where("o_orderkey % 11 <> 0").select("uid", "path", urls.alias("unitUrls"), F.lit("sig").alias("unitSig"))


_REASON = "CASE WHEN o_orderkey % 11 = 0 THEN 'new' " + " ".join(f"WHEN o_orderkey % 5 = {i} THEN '{r}'" for i, r in ((1, "no-unit-urls"), (2, "sig-changed"), (3, "inconsistent"), (4, "first-unit-moved"))) + " END"


@query(f"SELECT uid, {_REASON} AS reason FROM {ORDERS}")
def refresh_plan(spark, sf):
    return build.plan_refresh(*_modules(spark, sf))


@query(f"""SELECT uid, CASE WHEN reason IS NULL OR (f = 2 AND reason = 'first-unit-moved') THEN path || '/1-a,' || path || '/2-b' WHEN f = 0 THEN 'got' END AS urls, CASE WHEN reason IS NOT NULL AND f = 1 THEN true END AS missing FROM (SELECT *, {_REASON} AS reason, o_orderkey % 3 AS f FROM {ORDERS})""")
def resolved_units(spark, sf):
    now, old = _modules(spark, sf)
    plan = build.plan_refresh(now, old)
    fetched = plan.where("reason is not null").select("uid", cases(3, "ok", "not-found", "transient", key=F.col("uid").cast("long")).alias("outcome"), F.array(F.lit("got")).alias("urls"))
    return build.resolve_units(now, plan, old, fetched).select("uid", F.array_join("unitUrls", ",").alias("urls"), F.col("hierarchyNotFound").alias("missing"))


@query("""SELECT 'f' || s_suppkey AS family, CASE s_suppkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN s_suppkey % 3 = 0 END AS relevant, CASE WHEN s_suppkey % 4 < 2 THEN '2024-06-01' WHEN s_suppkey % 4 = 2 THEN '2024-01-01' END AS checked FROM supplier""")
def family_memo(spark, sf):
    k = F.col("s_suppkey")
    f = T(spark, sf, "supplier").select(F.concat(F.lit("f"), "s_suppkey").alias("family"), "s_suppkey")
    memo = f.where("s_suppkey % 4 = 2").select("family", (k % 3 == 0).alias("relevant"), F.lit("2024-01-01").alias("checked"), F.lit("s").alias("scope"))
    outcomes = f.where("s_suppkey % 4 <> 3").select("family", F.when(k % 4 == 0, 5).otherwise(0).alias("rows"), (k % 4 == 2).alias("failed"))
    return build.update_families(memo, f, outcomes, "s", "2024-06-01").select("family", "relevant", "checked")


@query("""SELECT '/c/' || conv_id AS toc, count(DISTINCT role) AS groups, count(DISTINCT 't' || turn) AS pages, CASE WHEN conv_id % 2 = 0 THEN '2024-01-01' ELSE '2024-06-01' END AS since FROM conversations WHERE turn IS NOT NULL GROUP BY conv_id""")
def toc_records(spark, sf):
    flat = QUERIES["toc_groups"](spark, sf).select("folder", "ord", F.array("title").alias("title"), F.lit(None).cast("string").alias("landing"), F.split("pages", ",").alias("pages"))
    first = runs.toc_run(flat, spark.createDataFrame([], "toc string, sig string, since string"), "2024-01-01")
    even = first.where("cast(substring(toc, 4) as long) % 2 = 0").select("toc", "sig", "since")
    return runs.toc_run(flat, even, "2024-06-01").select("toc", F.size("groups").cast("long").alias("groups"), F.col("pages").cast("long").alias("pages"), "since")


@query("""SELECT '/' || lang || '/' || source AS folder, count(*) AS n FROM documents GROUP BY lang, source HAVING count(*) >= 3""")
def toc_folders(spark, sf):
    d = T(spark, sf, "documents").select(F.concat_ws("/", F.lit(""), "lang", "source", F.col("doc_id").cast("string")).alias("path"))
    return runs.toc_directories(d, 3)


@query("""SELECT module, CAST(pos AS INT) AS pos, path, was FROM (SELECT *, row_number() OVER (PARTITION BY module, path ORDER BY pos) AS n FROM (SELECT o_custkey AS module, o_orderkey AS pos, CASE WHEN o_orderkey % 6 = 1 THEN '/training/modules/m' || o_orderkey || '/new' ELSE '/en/m' || o_orderkey END AS path, NULL AS was FROM orders WHERE false
 UNION ALL SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 6 = 1 THEN '/en/m' || o_orderkey || '/new' WHEN o_orderkey % 6 = 4 THEN '/en/t' || o_orderkey ELSE '/en/m' || o_orderkey END, CASE WHEN o_orderkey % 6 IN (1, 4) THEN '/en/m' || o_orderkey END FROM orders WHERE o_orderkey % 6 <> 5)) WHERE n = 1""")
def cleaned_links(spark, sf):
    o = O(spark, sf).withColumn("path", F.concat(F.lit("/en/m"), "o_orderkey"))
    links = o.select(F.col("o_custkey").alias("module"), K.cast("int").alias("pos"), "path")
    caches = validate.Caches(index=o.where("o_orderkey % 6 = 0").select("path"), redirects=o.where("o_orderkey % 6 = 1").select(F.col("path").alias("from"), F.concat("path", F.lit("/new")).alias("to")), quarantine=o.where("o_orderkey % 6 = 2").select("path"))
    probes = o.where("o_orderkey % 6 > 2").select("path", F.when(K % 6 == 3, "ok").when(K % 6 == 4, "moved").otherwise("broken").alias("verdict"), F.when(K % 6 == 4, F.concat(F.lit("/en/t"), "o_orderkey")).alias("redirects_to"))
    return runs.links_run(links, caches, probes, "2024-06-01", SITE).select("module", "pos", "path", "was")


@query("""SELECT 'r' || n_regionkey AS family, 'n' || n_nationkey AS loc, n_nationkey % 4 = 3 AS failed FROM nation""")
def nested_sitemaps(spark, sf):
    n = T(spark, sf, "nation")
    index = lambda locs: F.concat(F.lit("<sitemapindex>"), F.array_join(F.transform(locs, lambda x: F.concat(F.lit("<sitemap><loc>"), x, F.lit("</loc></sitemap>"))), ""), F.lit("</sitemapindex>"))
    middle = F.concat(F.lit("r"), "n_regionkey", F.lit("-"), F.col("n_nationkey") % 2)
    top = n.groupBy(F.concat(F.lit("r"), "n_regionkey").alias("loc")).agg(index(F.concat(F.collect_set(middle), F.array(F.first(F.concat(F.lit("r"), "n_regionkey"))))).alias("xml"))
    mid = n.groupBy(middle.alias("loc")).agg(index(F.collect_set(F.concat(F.lit("n"), "n_nationkey"))).alias("xml"))
    leaf = n.select(F.concat(F.lit("n"), "n_nationkey").alias("loc"), F.when(F.col("n_nationkey") % 4 != 3, "<urlset></urlset>").alias("xml"))
    found, failed = runs.sitemap_rounds(top.unionByName(mid).unionByName(leaf), top.select(F.col("loc").alias("family"), "loc"))
    return found.select("family", "loc", F.lit(False).alias("failed")).unionByName(failed.select("family", "loc", F.lit(True).alias("failed")))
