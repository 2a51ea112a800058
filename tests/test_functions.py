import pytest
from pyspark.sql import functions as F

from tidemark.config import Limits, Scope, Site, number_option
from tidemark.functions import paths as P
from tidemark.functions import scalars as S
from tidemark.functions import text as X


def values(spark, column, rows, schema="x string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r.y for r in df.select(column.alias("y")).collect()]


def test_canonical_path(spark):
    cases = {
        "https://Site.Example/en-us/Docs/X/?a=1#b": "/docs/x", "https://site.example": "/", "http://site.example/EN-US": "/", "https://other.example/x": None, "/fr-fr/a//": "/a",
        "/A/b?x": "/a/b", "docs/x": None, "": None, None: None, "ftp://site.example/x": None, "https://site.example/enx-us/y": "/enx-us/y", "/en-us-x/y": "/en-us-x/y", "https://user@site.example:8080/q/": "/q",
    }
    assert values(spark, P.canonical_path("x", "site.example"), list(cases)) == list(cases.values())
    assert values(spark, P.entry_path("x"), ["/", "/a/"]) == [None, "/a"]


def test_path_parts(spark):
    assert values(spark, P.parent_path("x"), ["/a/b/c", "/a", "/"]) == ["/a/b", None, None]
    assert values(spark, P.ancestors("x"), ["/a/b/c", "/a", "/"]) == [["/a", "/a/b", "/a/b/c"], ["/a"], ["/"]]
    assert values(spark, P.ancestors("x", False), ["/a/b", "/a"]) == [["/a"], []]
    assert values(spark, P.under_prefix("x", "cloud"), ["/cloud", "/cloud/x", "/cloud-x"]) == [True, True, False]
    assert values(spark, P.slug_text("x"), ["14-exercise", "2b-x", "x-1"]) == ["exercise", "x", "x-1"]
    assert values(spark, P.first_segment("x"), ["/a/b", "/"]) == ["a", None]
    assert values(spark, P.encoded("x"), ["a b/c"]) == ["a%20b%2Fc"]
    learn, index = Scope(("/docs",), ("/docs/internal",)), Scope(("/ref",))
    assert values(spark, P.scope_for("x", learn, index), ["/docs/a", "/docs/internal/b", "/ref", "/other"]) == ["learn", "excluded", "index-only", None]
    assert values(spark, P.is_module_path("x"), ["/training/saas/a", "/training/paths/a", "/docs"]) == [True, False, False]


def test_urls_and_files(spark):
    assert values(spark, P.normal_page_url("x", "h.example"), ["https://h.example/en-us/A/b?view=v1&q=2#f", "https://h.example/fr-fr/a", "https://o.example/en-us/a"]) == ["https://h.example/A/b?q=2", None, None]
    assert values(spark, P.sitemap_family("x").family, ["https://h/_sitemaps/cloud_en-us_3.xml", "https://h/x.xml"]) == ["cloud", None]
    assert values(spark, P.source_file_url("x", "content", "/docs", "d.example"), ["content/a/index.md", "content/b/c.md", "content/index.md"]) == ["https://d.example/docs/a", "https://d.example/docs/b/c", "https://d.example/docs"]
    assert values(spark, P.first_mapping("x", [("a/", "A"), ("b", "B")]), ["a/x", "bx", "c"]) == ["A", "B", None]


def test_relative_links(spark):
    rows = [("../x", "/a/b/c"), ("./y", "/a/b"), ("https://h.example/Q/?z", "/a"), ("https://o.example/q", "/a"), ("#top", "/a"), (None, "/a"), ("mailto:x@y", "/a"), ("", "/a")]
    df = spark.createDataFrame(rows, "h string, b string")
    got = [r.y for r in df.select(P.resolved("h", "b", "h.example").alias("y")).collect()]
    assert got == ["/a/x", "/a/y", "/Q", None, None, None, None, None]
    toc = spark.createDataFrame([("../b/page.md", "/docs/a"), ("index.yml", "/docs/a"), ("/x/y", "/docs/a")], "h string, f string")
    assert [r.y for r in toc.select(P.toc_target("h", "f").alias("y")).collect()] == ["/docs/b/page", "/docs/a/index", "/x/y"] or [r.y for r in toc.select(P.toc_target("h", "f").alias("y")).collect()] == ["/docs/b/page", "/docs/a", "/x/y"]


def test_dates_and_numbers(spark):
    assert values(spark, S.is_iso_date("x"), ["2024-02-29", "2023-02-29", "2024-2-8", None, "x"]) == [True, False, False, False, False]
    assert values(spark, S.days_between(F.lit("2024-01-01"), "x"), ["2024-01-31", "bad"]) == [30, None]
    assert values(spark, S.refresh_due("x", "2024-02-01", 30), ["2024-01-02", "2024-01-01", "junk", None]) == [False, True, True, True]
    assert values(spark, S.age_hours("x", "2024-01-02 00:00:00"), ["2024-01-01T12:30:00Z", "x"]) == [11.5, None]
    assert values(spark, S.list_some(F.split("x", ",")), ["a,b", "a,b,c,d,e"]) == ["a, b", "a, b, c, ... (+2 more)"]
    assert values(spark, S.fnv32("x"), ["", "a", "foobar"]) == [0x811C9DC5, 0xE40C292C, 0xBF9CF968]
    assert values(spark, S.status_class(F.col("x").cast("int")), ["200", "404", "429", "503", "403", None]) == ["ok", "notFound", "retry", "retry", "error", "retry"]
    assert S.retry_after_ms("12", 0) == 12_000 and S.retry_after_ms("Thu, 01 Jan 1970 00:00:05 GMT", 1000) == 4000 and S.retry_after_ms("x", 0) is None
    assert [S.backoff_ms(i) for i in range(3)] == [1000, 2000, 4000] and S.backoff_ms(9, retry_after=90_000) == 90_000
    assert S.scope_signature(Scope(("a", "b"))) == S.scope_signature(Scope(("b", "a"))) != S.scope_signature(Scope(("a",)))


def test_html(spark):
    html = "<html><head><title>A &amp; B | Site</title><meta name='robots' content='NOINDEX, follow'><meta content=\"d &lt;x&gt;\" name=\"description\"><meta name='robots' content='all'></head><body><h1>T</h1>lead <a href='/a'>one</a><h2>See <b>also</b></h2><a href=\"../b?x=1&amp;y\">t&#233;xt</a><a href='../b?x=1&amp;y'>again</a><h2>Feedback</h2><a href='/f'>f</a></main></body></html>"
    assert values(spark, X.page_title("x"), [html, "none"]) == ["A & B | Site", None]
    assert values(spark, X.clean_title(X.page_title("x")), [html]) == ["A & B"]
    assert values(spark, X.head_meta("x"), [html]) == [{"robots": "NOINDEX, follow", "description": "d <x>"}]
    assert values(spark, X.is_noindex(X.head_meta("x")), [html, "<meta name='a' content='b'>"]) == [True, False]
    assert values(spark, X.meta_content("x", "description"), [html, ""]) == ["d <x>", None]
    assert values(spark, X.article_html("x"), [html])[0].startswith("lead") and values(spark, X.article_html("x"), ["<p>"]) == [None]
    assert [(s.section, s.html[:4]) for s in values(spark, X.sections("x"), ["lead<h2>A</h2>one<H2 id=1>B</H2>two"])[0]] == [(None, "lead"), ("A", "one"), ("B", "two")]
    df = spark.createDataFrame([(1, html)], "id int, html string")
    assert [(r.section, r.href, r.text) for r in X.page_links(df, "html", "id").orderBy("pos").collect()] == [(None, "/a", "one"), ("See also", "../b?x=1&y", "téxt")]
    assert values(spark, X.unit_content("x", "<!--s-->", "<!--e-->"), ["a<!--s-->b<script>c</script>d<!--e-->", "a<!--s-->b"]) == ["bd", None]
    assert values(spark, X.only_code("x"), ["APL-1001 apl-1001", "APL-1001 APL-1002", "none"]) == ["apl-1001", None, None]
    assert values(spark, X.decoded("x"), ["&#x41;&#66; &amp;lt; &#xD800; &#9999999;"]) == ["AB &lt; &#xD800; &#9999999;"]


def test_other_formats(spark):
    xml = "<urlset><url><loc> https://h/a?x=1&amp;y </loc><lastmod>2024-01-01</lastmod></url><url><lastmod>x</lastmod></url><url><loc>b</loc></url></urlset>"
    assert [(r.loc, r.lastmod) for r in values(spark, X.urlset("x"), [xml])[0]] == [("https://h/a?x=1&y", "2024-01-01"), ("b", None)]
    assert values(spark, X.is_sitemap_index("x"), ["<sitemapindex xmlns='x'>", xml]) == [True, False]
    md = "---\ntitle: \"A: b\"\nms.prod: x\ntitle: C\n---\nbody"
    assert values(spark, X.frontmatter("x"), [md, "no"]) == [{"ms.prod": "x", "title": "C"}, None]
    assert values(spark, X.without_templates("x"), ["a {% if %} b {{ c }}", "{% x %}"]) == ["a b", None]
    assert values(spark, X.is_error_code("x", "module_id_not_found"), ['{"ErrorCode":"module_id_not_found"}', "{", None]) == [True, False, False]
    toc = '{"items":[{"toc_title":"A","href":"a","children":[{"toc_title":"x","href":"x1"},{"toc_title":"B","children":[{"href":"y"}]}]},{"toc_title":"E","children":[]}]}'
    rows = X.flatten_toc(spark.createDataFrame([("/d", toc), ("/e", "{"), ("/f", None)], "folder string, toc string")).orderBy("ord").collect()
    assert [(r.title, r.landing, r.pages) for r in rows] == [(["A"], "a", ["x1"]), (["A", "B"], None, ["y"])]
    h = spark.createDataFrame([('{"units":[{"uid":"u1","url":"/m/a/1"},{"uid":"u2","url":"/m/a/2"}]}', ["u1", "u2"]), ('{"units":[{"uid":"u1","url":"/m/a/1"}]}', ["u1", "u2"]), ('{"units":[{"uid":"u1","url":"/x/1"}]}', ["u1"]), ("{", [])], "b string, u array<string>")
    assert [r.o.outcome for r in h.select(X.hierarchy("b", F.lit("/m/a"), "u").alias("o")).collect()] == ["ok", "misaligned", "bad-shape", "bad-shape"]


def test_options():
    assert number_option({"A": " "}, "A", 3) == 3 and number_option({"A": "4"}, "A", 3) == 4
    for bad in ("x", "-1", "nan"):
        with pytest.raises(ValueError):
            number_option({"A": bad}, "A", 3)
    assert Limits.from_env({"TIDEMARK_PROBES": "7"}).probes == 7 and Limits.from_env({}) == Limits() and Site().host
