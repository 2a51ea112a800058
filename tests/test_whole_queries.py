"""Queries over whole tables against results made row by row, without SQL."""

import re

import pytest
from pyspark.sql import Row

from tidemark.functions import text as X
from tidemark.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return lambda name, *cols: [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*cols).collect()]


def rows(spark, name):
    return sorted((tuple(r) for r in QUERIES[name](spark, SF).collect()), key=repr)


def test_scope_three_hop_takes_all_customers(spark, tables):
    customers = {c for (c,) in tables("customer", "c_custkey")}
    of = {o for o, c in tables("orders", "o_orderkey", "o_custkey") if c in customers}
    used = {p for o, p in tables("lineitem", "l_orderkey", "l_partkey") if o in of}
    want = {f"/part/{p}" for p, size in tables("part", "p_partkey", "p_size") if p in used or size == 1}
    got = rows(spark, "scope_three_hop")
    assert got == sorted(((w,) for w in want), key=repr)


def test_check_changes_gives_every_link_a_row(spark, tables):
    got = {r[0]: r[1:] for r in rows(spark, "check_changes")}
    keys = [k for (k,) in tables("orders", "o_orderkey")]
    assert set(got) == {f"/p/{k}" for k in keys} and any(k % 2 for k in keys)
    assert all((got[f"/p/{k}"][0] == "none") == (k % 3 == 0) for k in keys)


def test_carry_forward_keeps_every_order(spark, tables):
    first = {}
    for o, *rest in tables("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"):
        first[o] = min(first.get(o, rest), rest)
    want = [(o, n, p, s if p % 4 or o % 2 == 0 else None) for o, (n, p, s) in first.items()]
    got = [(r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey) for r in QUERIES["carry_forward"](spark, SF).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(n > 1 for _, n, _, _ in got)


def test_page_title_gives_every_page_a_row(spark, tables):
    def title(html):
        t = re.search(r"(?is)<title[^>]*>(.*?)</title>", html)
        t = re.sub(r"<[^>]*>", "", t[1]) if t else ""
        for name, text in X.ENTITIES:
            t = t.replace(name, text)
        return re.sub(r"[\s ]+", " ", t).strip(" ") or None

    got = dict(rows(spark, "page_title"))
    assert got == {p: title(h) for p, h in tables("pages", "page_id", "html")}
    assert any("&" in (t or "") for t in got.values())


def test_titles_are_decoded(spark):
    df = spark.createDataFrame([Row(html="<title>A &amp; B &lt;c&gt; &#233;&#xe9;</title>"), Row(html="<p>none</p>")])
    assert [r.t for r in df.select(X.page_title("html").alias("t")).collect()] == ["A & B <c> éé", None]


def test_head_meta_against_an_html_parser(spark, tables):
    import json
    from html.parser import HTMLParser

    class Metas(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found, self.inside = {}, True

        def handle_starttag(self, tag, attrs):
            a = dict(attrs)
            name = (a.get("name") or a.get("property") or "").lower()
            if tag == "meta" and self.inside and name:
                self.found.setdefault(name, a.get("content") or "")

        def handle_endtag(self, tag):
            self.inside &= tag != "head"

    def metas(html):
        p = Metas()
        p.feed(html)
        return p.found

    got = {p: json.loads(m) for p, m in rows(spark, "head_meta")}
    assert got == {p: metas(h) for p, h in tables("pages", "page_id", "html")}


def test_drawn_sample_against_hashes_of_all_parts(spark, tables):
    import struct

    import xxhash

    def key(p):
        first = xxhash.xxh64(struct.pack("<i", 5), seed=42).intdigest()
        h = xxhash.xxh64(struct.pack("<q", p), seed=first).intdigest()
        return h - (1 << 64) if h >> 63 else h

    parts = sorted((p for (p,) in tables("part", "p_partkey")), key=key)
    assert sorted(p for (p,) in rows(spark, "drawn_sample")) == sorted(parts[:100])


def test_page_links_against_a_scan_of_each_page(spark, tables):
    def plain(html):
        t = re.sub(r"(?s)<[^>]*>", "", html)
        for name, text in X.ENTITIES:
            t = t.replace(name, text)
        return re.sub(r"\s+", " ", t.replace(" ", " ")).strip()

    def links(html):
        parts, seen, out = re.split(r"(?i)<p\b[^>]*>", html), set(), []
        for s, part in enumerate(parts):
            name, body = None, part
            if s:
                end = re.search(r"(?is)</p\s*>", part)
                name, body = (plain(part[: end.start()]), part[end.end() :]) if end else (None, part)
            for i, m in enumerate(re.finditer(r"""(?is)<a\s[^>]*?href=["']([^"']*)["'][^>]*>(.*?)</a\s*>""", body)):
                if (name or "", m[1]) not in seen:
                    seen.add((name or "", m[1]))
                    out.append((s * 100_000 + i, m[1], plain(m[2])[:200]))
        return out

    got = {}
    for page, pos, _, href, text in ((r.page_id, r.pos, r.section, r.href, r.text) for r in QUERIES["page_links"](spark, SF).collect()):
        got.setdefault(page, []).append((pos, href, text))
    want = {p: x for p, h in tables("pages", "page_id", "html") if (x := links(h))}
    assert {p: sorted(x) for p, x in got.items()} == want
