"""Commands of the runs that carry tables forward, on folders of tables."""

import io
import json

import pytest

from tidemark import cli
from tidemark.operators import ledger as L
from tidemark.sources import files


def put(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}")


def said(spark, *args):
    out = io.StringIO()
    code = cli.main([str(a) for a in args], spark, stdout=out)
    return code, dict(line.split(": ", 1) for line in out.getvalue().splitlines())


def test_sidebars(spark, tmp_path):
    tables, out = tmp_path / "in", tmp_path / "out"
    toc = json.dumps({"items": [{"toc_title": "A", "children": [{"href": "x"}]}]})
    put(spark, tables, index=([(f"/docs/a/p{i}", None) for i in range(3)] + [(f"/docs/b/p{i}", None) for i in range(3)], "path string, lastmod string"), answers=([("/docs/a", "ok", toc), ("/docs/b", "notFound", None)], "folder string, outcome string, toc string"))
    code, told = said(spark, "sidebars", "--tables", tables, "--today", "2024-06-01", "--out", out)
    assert (code, told["asked"], told["tocs"], told["without"], told["written"]) == (0, "2", "1", "1", "tocs, none")
    for name in ("tocs", "none"):
        spark.read.parquet(f"{out}/{name}").write.parquet(f"{tables}/{name}")
    code, told = said(spark, "sidebars", "--tables", tables, "--today", "2024-06-08", "--out", out)
    assert (code, told["asked"], told["written"]) == (0, "1", "nothing")
    assert cli.main(["sidebars", "--tables", str(tmp_path), "--today", "2024-06-08"], spark, stdout=io.StringIO()) == 2


def test_links(spark, tmp_path):
    tables, out = tmp_path / "in", tmp_path / "out"
    m = "/training/modules/a"
    link = "array<struct<kind: string, path: string, url: string, text: string, section: string>>"
    put(
        spark, tables, modules=([(m, [f"{m}/1"], "s1", None)], "path string, unitUrls array<string>, unitSig string, hierarchyNotFound boolean"), index=([("/docs/x",)], "path string"),
        pages=([(m, "ok", "T", [("docs", "/docs/x", None, "x", None), ("docs", "/docs/gone", None, "g", None)])], f"path string, outcome string, unitTitle string, links {link}"), checks=([("/docs/gone", "broken", None)], "path string, verdict string, redirects_to string"),
    )
    code, told = said(spark, "links", "--tables", tables, "--today", "2024-06-01", "--out", out)
    assert (code, told["asked"], told["links_drop"], told["full_at"]) == (0, "1", "1", "2024-06-01")
    assert [r.path for r in spark.read.parquet(f"{out}/links").collect()] == ["/docs/x"]


def test_catalogue_and_content(spark, tmp_path):
    tables, out, folder = tmp_path / "in", tmp_path / "out", tmp_path / "ledger"
    folder.mkdir()
    m = "uid string, title string, path string, products array<string>, units array<string>, lastModified string, firstUnitPath string"
    put(
        spark, tables, api=([("m1", "One", "/training/modules/one", ["p1"], ["u1"], "2024-01-01", "/training/modules/one/1-a")], m), units=([("u1", "a")], "uid string, lastModified string"),
        taxonomy=([("P", "P", [("p1", "p one")])], "id string, name string, children array<struct<id: string, name: string>>"), fetched=([("m1", "ok", ["/training/modules/one/1-a"])], "uid string, outcome string, urls array<string>"),
        current=([("exam", "e1", "E", "/credentials/certifications/exams/e1")], "type string, uid string, title string, path string"),
    )
    code, told = said(spark, "catalogue", "--tables", tables, "--ledger", folder, "--allowed", "P", "--today", "2024-06-01", "--out", out)
    assert (code, told["modules"], told["changes"]) == (0, "1", "0") and spark.read.parquet(f"{out}/modules").first().unitUrls == ["/training/modules/one/1-a"]
    code, told = said(spark, "content", "--tables", tables, "--ledger", folder, "--today", "2024-06-01", "--out", out)
    assert (code, told["items"], told["removed"]) == (0, "1", "0")
    assert files.read_ledger(spark, str(folder)).select(L.COLUMNS).count() == 0
    put(spark, tables, previous=([(f"m{i}", "T", f"/training/modules/m{i}", ["p1"], [], "d", None, None, "s", None) for i in range(9)], f"{m}, unitUrls array<string>, unitSig string, hierarchyNotFound boolean"))
    assert cli.main(["catalogue", "--tables", str(tables), "--ledger", str(folder), "--allowed", "P", "--today", "2024-06-08"], spark, stdout=io.StringIO()) == 1


@pytest.mark.parametrize("command", ["sidebars", "links", "catalogue", "content"])
def test_arguments(spark, command):
    assert cli.main([command], spark, stdout=io.StringIO()) == 2
