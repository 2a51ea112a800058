"""Column functions that take HTML, XML, JSON and Markdown apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .paths import bound, col, trimmed

#: Sections that are page furniture: of articles, and of unit pages (fixed values).
SKIP_ARTICLE = "(?i)feedback|in this article|additional resources"
SKIP_UNIT = "(?i)copilot|feedback|check your knowledge|knowledge check|learning objectives"
#: Entities by name (fixed values); &amp; comes last so that nothing is decoded twice.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&nbsp;", " "), ("&mdash;", "—"), ("&ndash;", "–"), ("&rsquo;", "’"), ("&lsquo;", "‘"), ("&amp;", "&"))
XML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def decoded(c: Column | str, entities=ENTITIES) -> Column:
    """Numeric entities, then named ones; all begin with an ampersand, so a text without one stays as it is."""

    def numeric(p: Column) -> Column:
        hexa, dec = F.regexp_extract(p, r"^&#x([0-9A-Fa-f]{1,6});", 1), F.regexp_extract(p, r"^&#([0-9]{1,7});", 1)
        code = F.when(hexa != "", F.conv(hexa, 16, 10).try_cast("int")).when(dec != "", dec.try_cast("int"))
        good = code.isNotNull() & (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
        return F.when(good, F.concat(F.decode(utf32, "UTF-32"), F.regexp_replace(p, r"^&#[0-9A-Fa-fx]+;", ""))).otherwise(p)

    def of(text: Column) -> Column:
        out = F.array_join(F.transform(F.split(text, r"(?=&#(?:x[0-9A-Fa-f]{1,6}|[0-9]{1,7});)"), numeric), "")
        for name, plain in entities:
            out = F.replace(out, F.lit(name), F.lit(plain))
        return F.when(text.contains("&"), out).otherwise(text)

    return bound(col(c), of)


def decoded_xml(c: Column | str) -> Column:
    out = trimmed(c)
    for name, text in XML_ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(text))
    return out


def text_of(html: Column | str) -> Column:
    """Without tags, entities decoded, white space collapsed."""
    return F.trim(F.regexp_replace(decoded(F.regexp_replace(col(html), r"<[^>]*>", "")), r"[\s ]+", " "))


def between(c: Column | str, start: str, end: str) -> Column:
    """What stands between two markers; null where either is missing."""

    def cut(rest: Column) -> Column:
        return bound(F.locate(end, rest), lambda b: F.when(b > 0, F.substring(rest, F.lit(1), b - 1)))

    def of(text: Column) -> Column:
        return bound(F.locate(start, text), lambda a: F.when(a > 0, bound(F.substring(text, a + len(start), F.length(text)), cut)))

    return bound(col(c), of)


def without_scripts(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?is)<(script|style|template)\b.*?</\1\s*>", "")


def unit_content(html: Column | str, start: str, end: str) -> Column:
    """A page's content between two id markers, without scripts, styles and templates."""
    return without_scripts(between(html, start, end))


def article_html(html: Column | str, end_marker: str = "</main>") -> Column:
    """What follows the first </h1>, up to the end marker; null for another layout."""
    return between(html, "</h1>", end_marker)


def page_title(html: Column | str) -> Column:
    return F.nullif(text_of(F.regexp_extract(col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def meta_content(html: Column | str, name: str) -> Column:
    """The content of a named meta element, its attributes in either order."""
    c = col(html)
    one = F.regexp_extract(c, rf"""(?is)<meta\s[^>]*?(?:name|property)=["']{name}["'][^>]*?content=["']([^"']*)["']""", 1)
    two = F.regexp_extract(c, rf"""(?is)<meta\s[^>]*?content=["']([^"']*)["'][^>]*?(?:name|property)=["']{name}["']""", 1)
    return decoded(F.nullif(F.coalesce(F.nullif(one, F.lit("")), two), F.lit("")))


def head_meta(html: Column | str) -> Column:
    """map of every named meta element of the head, lower-case names, the first of a name wins."""
    head = F.coalesce(F.nullif(F.regexp_extract(col(html), r"(?is)^(.*?)</head>", 1), F.lit("")), col(html))
    tags = F.regexp_extract_all(head, F.lit(r"(?is)(<meta\s[^>]*>)"), 1)
    named = F.filter(
        F.transform(tags, lambda t: F.struct(F.lower(F.regexp_extract(t, r"""(?is)(?:name|property)=["']([^"']*)["']""", 1)).alias("k"), decoded(F.regexp_extract(t, r"""(?is)content=["']([^"']*)["']""", 1)).alias("v"))),
        lambda e: e.k != "",
    )
    first = F.aggregate(
        named,
        F.array().cast("array<struct<k:string,v:string>>"),
        lambda done, e: F.when(F.exists(done, lambda d: d.k == e.k), done).otherwise(F.concat(done, F.array(e))),
    )
    return F.map_from_entries(first)


def is_noindex(meta: Column | str) -> Column:
    m = col(meta)
    robots = F.coalesce(F.nullif(F.try_element_at(m, F.lit("robots")), F.lit("")), F.try_element_at(m, F.lit("ms.robots")))
    return F.coalesce(robots.rlike(r"(?i)\bnoindex\b"), F.lit(False))


def clean_title(c: Column | str, suffix: str = r"\s*\|\s*[^|]*$") -> Column:
    """A title without the site's suffix."""
    return trimmed(F.regexp_replace(col(c), suffix, ""))


def record_from_head(title: Column | str, meta: Column | str) -> Column:
    """struct(title, product, subproduct, description) of a page's head; null without a title."""
    m = col(meta)
    item = lambda *names: F.coalesce(*(F.nullif(F.try_element_at(m, F.lit(n)), F.lit("")) for n in names))
    t = F.coalesce(F.nullif(clean_title(title), F.lit("")), F.nullif(clean_title(item("og:title")), F.lit("")))
    made = F.struct(t.alias("title"), item("ms.prod", "ms.service").alias("product"), item("ms.technology", "ms.subservice").alias("subproduct"), item("description", "og:description").alias("description"))
    return F.when(t.isNotNull(), made)


def frontmatter(c: Column | str) -> Column:
    """map of the 'key: value' lines of a leading --- block; null without one.  The last of a key wins."""
    block = F.regexp_extract(col(c), r"(?s)^﻿?---\r?\n(.*?)\r?\n---", 1)
    lines = F.filter(F.split(block, r"\r?\n"), lambda x: x.rlike(r"^[A-Za-z0-9_.-]+\s*:"))
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"^([A-Za-z0-9_.-]+)", 1).alias("k"), F.regexp_replace(F.trim(F.regexp_extract(x, r"^[^:]*:(.*)$", 1)), r"""^["'](.*)["']$""", "$1").alias("v")))
    last = F.filter(pairs, lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda f: f.k == e.k))
    return F.when(col(c).rlike(r"(?s)^﻿?---\r?\n.*?\r?\n---"), F.map_from_entries(last))


def without_templates(c: Column | str) -> Column:
    """Without {% %} and {{ }} tags, spaces collapsed; null when nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(col(c), r"(?s)\{%.*?%\}|\{\{.*?\}\}", ""), r"\s+", " ")), F.lit(""))


def sections(html: Column | str, tag: str = "h2") -> Column:
    """array of struct(section, html), split at a heading; the lead comes first, without a name."""
    parts = F.split(col(html), rf"(?i)<{tag}\b[^>]*>")
    end = rf"(?is)^(.*?)</{tag}\s*>"
    return F.transform(
        parts,
        lambda p, i: F.struct(
            F.when(i > 0, text_of(F.regexp_extract(p, end, 1))).alias("section"),
            F.when(i > 0, F.regexp_replace(p, end, "")).otherwise(p).alias("html"),
        ),
    )


def anchors(html: Column | str) -> Column:
    """array of struct(href, text, linktype) in page order."""
    found = F.regexp_extract_all(col(html), F.lit(r"""(?is)(<a\s[^>]*?href=["'][^"']*["'][^>]*>.*?</a\s*>)"""), 1)
    return F.transform(found, lambda a: F.struct(decoded(F.regexp_extract(a, r"""(?is)href=["']([^"']*)["']""", 1)).alias("href"), text_of(a).alias("text"), F.nullif(F.lower(F.regexp_extract(a, r"""(?is)^<a\s[^>]*?data-linktype=["']([^"']*)["']""", 1)), F.lit("")).alias("linktype")))


def page_links(pages: DataFrame, html: Column | str, key: str, tag: str = "h2", skip: str = SKIP_ARTICLE, with_type: bool = False) -> DataFrame:
    """key, pos, section, href, text: a page's links in order, the first of (section, href) only, some sections left out."""
    s = pages.select(F.col(key), F.posexplode(sections(html, tag)).alias("s", "part")).where(F.col("part.section").isNull() | ~F.col("part.section").rlike(skip))
    a = s.select(key, "s", F.col("part.section").alias("section"), F.posexplode(anchors("part.html")).alias("i", "a"))
    from ..operators.dedupe import first_per

    rows = a.select(key, "s", "i", "section", "a.href", F.substring("a.text", 1, 200).alias("text"), "a.linktype")
    one = first_per(rows.withColumn("_s", F.coalesce("section", F.lit(""))), [key, "_s", "href"], [F.col("s"), F.col("i")]).drop("_s")
    return one.select(key, (F.col("s") * 100_000 + F.col("i")).alias("pos"), "section", "href", "text", *(["linktype"] if with_type else []))


def article_links(pages: DataFrame, html: str, path: str, host: str, end_marker: str = "</main>") -> DataFrame:
    """path, pos, section, target, text: the pages of the site that articles lead to, the first of (section, target).

    Links marked external or as a bookmark of the page, those without text, to
    other hosts or to the page itself are left out; the lead is section 'lead'.
    A page of another layout (no heading, or no end of the article) has no rows.
    """
    from ..operators.dedupe import first_per
    from .paths import link_target, present

    articles = pages.select(F.col(path).alias("path"), present(article_html(html, end_marker)).alias("_article"))
    rows = page_links(articles, "_article", "path", with_type=True).where("coalesce(linktype, '') not in ('external', 'self-bookmark') and text <> ''")
    rows = rows.select("path", "pos", F.coalesce(F.nullif("section", F.lit("")), F.lit("lead")).alias("section"), present(link_target("href", "path", host)).alias("target"), "text")
    return first_per(rows, ["path", "section", "target"], [F.asc("pos")])


def xml_blocks(xml: Column | str, tag: str) -> Column:
    """array of struct(loc, lastmod) of all <tag> blocks that have a loc."""
    blocks = F.regexp_extract_all(col(xml), F.lit(rf"(?is)(<{tag}\b[^>]*>.*?</{tag}\s*>)"), 1)
    one = lambda b, t: F.nullif(decoded_xml(F.regexp_extract(b, rf"(?is)<{t}\b[^>]*>(.*?)</{t}\s*>", 1)), F.lit(""))
    return F.filter(F.transform(blocks, lambda b: F.struct(one(b, "loc").alias("loc"), one(b, "lastmod").alias("lastmod"))), lambda r: r.loc.isNotNull())


def sitemap_index(xml: Column | str) -> Column:
    return xml_blocks(xml, "sitemap")


def urlset(xml: Column | str) -> Column:
    return xml_blocks(xml, "url")


def is_sitemap_index(xml: Column | str) -> Column:
    return col(xml).rlike(r"<sitemapindex[\s>]")


def only_code(html: Column | str, pattern: str = r"(?i)\b(APL-\d{4})\b") -> Column:
    """The one different code on a page; null for none or several."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(col(html), F.lit(pattern), 1), F.lower))
    return F.when(F.size(found) == 1, found[0])


def is_error_code(body: Column | str, code: str) -> Column:
    """A JSON error body with this ErrorCode; anything unreadable is not one."""
    return F.coalesce(F.get_json_object(col(body), "$.ErrorCode") == code, F.lit(False))


HIERARCHY = T.StructType([T.StructField("units", T.ArrayType(T.StructType([T.StructField("uid", T.StringType()), T.StructField("url", T.StringType())])))])


def hierarchy(body: Column | str, module: Column | str, uids: Column | str, host: str | None = None) -> Column:
    """struct(outcome, urls): 'ok' with the unit paths, 'bad-shape', or 'misaligned' with the catalogue's units."""
    from .paths import canonical_path

    parsed = F.from_json(col(body), HIERARCHY)
    urls = F.transform(parsed.units, lambda u: canonical_path(u.url, host))
    below = F.forall(urls, lambda u: u.isNotNull() & u.startswith(F.concat(col(module), F.lit("/"))))
    shape = parsed.units.isNotNull() & (F.size(parsed.units) > 0) & below & (F.size(F.array_distinct(urls)) == F.size(urls))
    same = F.transform(parsed.units, lambda u: u.uid) == col(uids)
    outcome = F.when(F.coalesce(shape, F.lit(False)) & F.coalesce(same, F.lit(False)), "ok").when(~F.coalesce(shape, F.lit(False)), "bad-shape").otherwise("misaligned")
    return F.struct(outcome.alias("outcome"), F.when(outcome == "ok", urls).alias("urls"))


def flatten_toc(tocs: DataFrame, json_column: str = "toc", folder: str = "folder") -> DataFrame:
    """A recursive sidebar as flat groups: folder, ord, title (breadcrumb), landing, pages, in sidebar order.

    A group is an entry with children; its pages are the children's own links.
    Groups without pages are left out.  Spark structs cannot be recursive, so
    the walk runs in Python, a sidebar at a time.
    """
    import json

    def walk(items, trail, out):
        for item in items or []:
            if not isinstance(item, dict):
                continue
            below = item.get("children") or item.get("items")
            if isinstance(below, list):
                title = [*trail, str(item.get("toc_title") or item.get("name") or "")]
                pages = [c["href"] for c in below if isinstance(c, dict) and isinstance(c.get("href"), str)]
                if pages or item.get("href"):
                    out.append((title, item.get("href"), pages))
                walk(below, title, out)

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for f, text in zip(frame[folder], frame[json_column]):
                try:
                    top = json.loads(text) if text else {}
                except ValueError:
                    continue
                out: list = []
                walk(top.get("items") if isinstance(top, dict) else top, [], out)
                rows += [(f, i, t, h, p) for i, (t, h, p) in enumerate(out)]
            yield pd.DataFrame(rows, columns=["folder", "ord", "title", "landing", "pages"])

    return tocs.select(folder, json_column).mapInPandas(run, "folder string, ord int, title array<string>, landing string, pages array<string>")
