"""Links are resolved once a row, however often an expression names the result."""

import pytest

from tidemark.functions import paths as P
from tidemark.functions import text as X

HREFS = ["x", "../y?v=1", "./a/../b.md", "/fr-fr/Abs/z/", "//site.example/Q", "https://other.example/a", "HTTPS://site.example/en-us/q#top", "mailto:a@b", "#part", "", " ", "a b/ü", "?only=query", "../../../up", "/", "/en-us", "/en-us/", None]
WANT = ["/d/x", "/y", "/d/b.md", "/abs/z", "/q", None, "/q", None, None, None, None, "/d/a%20b/%c3%bc", None, "/up", "/", "/", "/", None]


def folds(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("aggregate(")


def test_link_targets(spark):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(HREFS)], "i int, h string").withColumn("page", P.F.lit("/d/a"))
    got = [r.t for r in df.select("i", P.link_target("h", "page", "site.example").alias("t")).orderBy("i").collect()]
    assert got == WANT


@pytest.mark.parametrize("made", [lambda h: P.link_target(h, P.F.lit("/d/a"), "site.example"), lambda h: P.toc_target(h, P.F.lit("/d"), "site.example"), lambda h: P.toc_folder(P.F.lit("/d/a"), h)])
def test_a_target_has_one_fold(spark, made):
    df = spark.createDataFrame([("x",)], "h string")
    assert folds(df.select(made("h").alias("t"))) == 1


def test_article_links_have_one_fold(spark):
    pages = spark.createDataFrame([("/d/a", "<h1>T</h1><a href='b'>B &amp; C</a></main>"), ("/d/b", "<a href='b'>B</a></main>"), ("/d/c", None)], "path string, html string")
    links = X.article_links(pages, "html", "path", "site.example")
    assert folds(links) == 1
    assert [tuple(r) for r in links.collect()] == [("/d/a", 0, "lead", "/d/b", "B & C")]


def test_markers_and_entities(spark):
    texts = ["<h1>a</h1>b</main>c</main>", "</main></h1>", "</h1></main>", "no", "", None, "</h1>&lt;x&#233;</main>"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", X.between("t", "</h1>", "</main>").alias("b"), X.decoded("t").alias("d")).orderBy("i").collect()
    assert [r.b for r in got] == ["b", None, "", None, None, None, "&lt;x&#233;"]
    assert [r.d for r in got] == texts[:6] + ["</h1><xé</main>"]
