import io
import json
import subprocess

import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.config import GateFailure, Site
from tidemark.operators import ledger as L
from tidemark.operators import records
from tidemark.plans import runs, validate
from tidemark.sources import files, probes


def none(spark):
    return spark.createDataFrame([], L.ENTRY)


def test_catalogue_run(spark):
    module = "uid string, title string, path string, products array<string>, units array<string>, lastModified string, firstUnitPath string"
    api = spark.createDataFrame([("m1", "One", "/training/modules/one", ["p1"], ["u1", "u2"], "2024-01-01", "/training/modules/one/1-a"), ("m2", "Two", "/training/modules/two-new", ["p1"], ["u3"], "2024-01-01", None), ("m9", "Other", "/training/modules/other", ["q1"], [], "2024-01-01", None)], module)
    units = spark.createDataFrame([("u1", "a"), ("u2", "b"), ("u3", "c")], "uid string, lastModified string")
    taxonomy = spark.createDataFrame([("P", "P", [("p1", "p one")]), ("Q", "Q", [("q1", "q one")])], "id string, name string, children array<struct<id:string,name:string>>")
    prev = "uid string, path string, title string, unitUrls array<string>, unitSig string, hierarchyNotFound boolean"
    previous = spark.createDataFrame([("m1", "/training/modules/one", "One", ["/training/modules/one/1-a", "/training/modules/one/2-b", "/training/modules/one/3-c"], "x", None), ("m2", "/training/modules/two", "Two", None, "x", None), ("m3", "/training/modules/three", "Three", None, "x", None)], prev)
    removed = spark.createDataFrame([], "uid string, path string, title string, lastSeen string, removedOn string")
    fetched = spark.createDataFrame([("m1", "ok", ["/training/modules/one/1-a", "/training/modules/one/2-b"]), ("m2", "not-found", None)], "uid string, outcome string, urls array<string>")
    asked = []

    def probe(q):
        asked.extend(r.path for r in q.collect())
        return spark.createDataFrame([(p, "gone", None, 404) for p in asked], "path string, outcome string, to string, status int")

    out = runs.catalogue_run(api, units, taxonomy, previous, removed, fetched, none(spark), probe, ["P"], "2024-06-01", most_drop=50)
    assert {(r.uid, r.hierarchyNotFound) for r in out.modules.collect()} == {("m1", None), ("m2", True)}
    assert [r.path for r in out.out_of_scope.collect()] == ["/training/modules/other"]
    assert [(r.uid, r.removedOn) for r in out.removed.collect()] == [("m3", "2024-06-01")]
    assert {r.uid: r.reason for r in out.refresh.collect()} == {"m1": "sig-changed", "m2": "no-unit-urls"}
    assert sorted(asked) == ["/training/modules/one/3-c", "/training/modules/three", "/training/modules/two", "/training/modules/two-new"]
    assert {(r.path, r.outcome, r.evidence) for r in out.ledger.collect()} == {("/training/modules/one/3-c", "gone", "unit-diff"), ("/training/modules/three", "gone", "tombstone"), ("/training/modules/two", "gone", "rename"), ("/training/modules/two-new", "gone", "hierarchy-not-found")}
    with pytest.raises(GateFailure):
        runs.catalogue_run(api, units, taxonomy, previous, removed, fetched, none(spark), probe, ["P"], "2024-06-01", least=5)


def test_content_run(spark):
    item = "type string, uid string, title string, path string"
    current = spark.createDataFrame([("exam", "e1", "E", "/credentials/certifications/exams/e1"), ("course", "c1", "C", "/training/courses/new")], item)
    previous = spark.createDataFrame([("exam", "e1", "E", "/credentials/certifications/exams/e1", "/credentials/certifications/resources/study-guides/e1"), ("course", "c1", "C", "/training/courses/old", None)], item + ", studyGuide string")
    removed = spark.createDataFrame([], "type string, uid string, path string, title string, lastSeen string, removedOn string")
    probes = spark.createDataFrame([("e1", "/g", "absent")], "uid string, path string, outcome string")
    nothing = lambda q: spark.createDataFrame([], "path string, outcome string, to string, status int")
    items, gone, ledger = runs.content_run(current, probes, previous, removed, none(spark), spark.createDataFrame([], "path string"), nothing, "2024-06-01")
    assert {(r.uid, r.studyGuide, r.guideKnown) for r in items.collect()} == {("e1", None, True), ("c1", None, False)} and gone.count() == 0
    assert {(r.path, r.kind, r.outcome) for r in ledger.collect()} == {("/training/courses/old", "course", "unverified"), ("/credentials/certifications/resources/study-guides/e1", "study-guide", "unverified")}


def test_docs_run(spark):
    host = "h.example"
    xml = "<urlset>" + "".join(f"<url><loc>https://{host}/en-us/docs/{p}</loc><lastmod>{d}</lastmod></url>" for p, d in (("a", "2024-02-01"), ("b", "2024-01-01"), ("n", "2024-02-01"), ("internal/x", "2024-01-01"))) + "</urlset>"
    files_ = spark.createDataFrame([("docs", xml), ("bad", None)], "family string, xml string")
    memo = spark.createDataFrame([("bad", True, "2024-01-01", "s")], "family string, relevant boolean, checked string, scope string")
    rows, memo = runs.sitemap_pass(files_, Site(), host, memo, "sig", "2024-02-02")
    assert sorted(r.path for r in rows.collect()) == ["/docs/a", "/docs/b", "/docs/n"]
    assert {(r.family, r.relevant, r.checked) for r in memo.collect()} == {("docs", True, "2024-02-02"), ("bad", True, "2024-01-01")}
    catalogue = spark.createDataFrame([(f"/docs/{p}", "2024-01-01", f"https://{host}/docs/{p}", f"Page {p}", "2024-01-15", "prod") for p in "abm"], "path string, lastmod string, url string, title string, checked string, product string")
    q = spark.createDataFrame([], "path string, url string, title string, status int, firstDetected string, lastChecked string")
    red = spark.createDataFrame([("/docs/old", "/docs/a", "moved", 301, "2024-01-01", "2024-01-01")], "from string, to string, kind string, status int, firstSeen string, lastSeen string")
    results = spark.createDataFrame([("/docs/m", "moved", 301, "/docs", None), ("/docs/n", "gone", 404, None, None), ("/docs/a", "live", 200, None, "New A")], "path string, outcome string, status int, to string, title string")
    out = runs.docs_run(rows, catalogue, catalogue.select("path", "lastmod"), q, red, results, none(spark), "2024-02-02")
    assert {r.path: r.action for r in out.plan.collect()} == {"/docs/a": "changed", "/docs/b": "kept", "/docs/n": "new", "/docs/m": "missing"}
    assert sorted(r.path for r in out.index.collect()) == ["/docs/a", "/docs/b", "/docs/n"]  # a new page that is not there yet is a sitemap ahead of its site
    assert {tuple(r) for r in out.records.collect()} == {("/docs/a", f"https://{host}/docs/a", "New A", "2024-02-01", "2024-02-02", "prod"), ("/docs/b", f"https://{host}/docs/b", "Page b", "2024-01-01", "2024-01-15", "prod")}
    assert {(r["from"], r.kind) for r in out.redirects.collect()} == {("/docs/old", "moved"), ("/docs/m", "landing")}
    assert {(r.path, r.outcome) for r in out.ledger.collect()} == {("/docs/old", "moved"), ("/docs/m", "landing")}
    assert {r.name: r.n for r in out.counts.collect()} == {"indexUrls": 3, "catalogRecords": 2, "pendingNew": 1, "deferredChanged": 0, "deferredMissing": 0, "quarantined": 0, "moved": 1, "released": 0}
    assert {(r.path, r.phase) for r in runs.queue_budget(out.plan, today="2024-02-02").collect()} == {("/docs/a", "fetch"), ("/docs/n", "fetch"), ("/docs/b", "verify"), ("/docs/m", "missing")}


def test_nested_sitemap_indexes(spark):
    index = lambda *locs: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in locs) + "</sitemapindex>"
    pages = "<urlset><url><loc>https://h/en-us/p</loc></url></urlset>"
    table = [("r", index("a", "b", "r")), ("a", index("a1", "r", "gone")), ("a1", pages), ("b", pages), ("gone", None), ("other", pages), ("s", index("b", "never"))]
    files_ = spark.createDataFrame(table, "loc string, xml string")
    found, failed = runs.sitemap_rounds(files_, spark.createDataFrame([("r", "one"), ("s", "two")], "loc string, family string"))
    assert {(r.family, r.loc) for r in found.collect()} == {("one", "a1"), ("one", "b"), ("two", "b")}
    assert {(r.family, r.loc) for r in failed.collect()} == {("one", "gone"), ("two", "never")}
    found, failed = runs.sitemap_rounds(files_, spark.createDataFrame([("r", "one")], "loc string, family string"), most_rounds=1)
    assert {r.loc for r in found.collect()} == {"b"} and {r.loc for r in failed.collect()} == {"a"}


def test_links_tocs_and_seeds(spark):
    caches = validate.Caches(index=spark.createDataFrame([("/docs/a",)], "path string"), redirects=spark.createDataFrame([("/docs/b", "/docs/a")], "from string, to string"))
    links = spark.createDataFrame([("m", 0, "/docs/b"), ("m", 1, "/docs/a"), ("m", 2, "/docs/z"), ("m", 3, "/docs/y")], "module string, pos int, path string")
    probes = spark.createDataFrame([("/docs/z", "broken", None)], "path string, verdict string, redirects_to string")
    out = runs.links_run(links, caches, probes, "2024-06-01").orderBy("pos").collect()
    assert [(r.path, r.was) for r in out] == [("/docs/a", "/docs/b"), ("/docs/y", None)]
    groups = spark.createDataFrame([("/t", 0, ["A"], None, ["/x", "/y"]), ("/t", 1, ["B"], None, ["/y"])], "folder string, ord int, title array<string>, landing string, pages array<string>")
    first = runs.toc_run(groups, spark.createDataFrame([], "toc string, sig string, since string"), "2024-01-01")
    again = runs.toc_run(groups, first, "2024-02-01").collect()[0]
    assert (again.since, again.pages) == ("2024-01-01", 2)
    snaps = spark.createDataFrame([("/training/modules/a", "2024-01-01", "module"), ("/training/modules/b", "2024-01-01", "module"), ("/training/modules/b", "2024-01-08", "module")], "path string, day string, kind string")
    nothing = lambda q: spark.createDataFrame([], "path string, outcome string, to string, status int")
    modules = validate.Caches(modules=spark.createDataFrame([("/training/modules/b", None, None)], "path string, unitUrls array<string>, hierarchyNotFound boolean"))
    after, report = runs.seed_run(snaps, spark.createDataFrame([("/training/modules/z",)], "url string"), modules, none(spark), snaps.where("day = '2024-01-08'").select("path"), nothing, today="2024-02-01")
    assert {(r.path, r.firstSeen) for r in after.collect()} == {("/training/modules/a", "2024-01-08"), ("/training/modules/z", "2024-02-01")}
    assert {(r.change, r.n) for r in report.collect()} == {("added:unverified", 2)}


def test_cli(spark, tmp_path):
    ledger = spark.createDataFrame([("moved", "/a", "docs", "docs", "moved", "/b", None, None, "2024-01-01", None, "docs-redirect", 301)], L.ENTRY)
    files.write_ledger(ledger, str(tmp_path), "2024-01-01T00:00:00Z")
    out = io.StringIO()
    assert cli.main(["check", "/a", "/q", "--all", "--ledger", str(tmp_path)], spark, stdout=out) == 1
    assert {(r["path"], r["status"]) for r in json.loads(out.getvalue())["rows"]} == {("/a", "moved"), ("/q", "none")}
    assert cli.main(["since", "2024-01-01", "--ledger", str(tmp_path)], spark, stdout=io.StringIO()) == 0
    assert cli.main(["since", "soon", "--ledger", str(tmp_path)], spark, stdout=io.StringIO()) == 2
    assert cli.main(["check", "--ledger", str(tmp_path)], spark, stdin=io.StringIO("{"), stdout=io.StringIO()) == 2
    assert cli.main(["nonsense"], spark) == 2
    spark.createDataFrame([("/docs/a",)], "path string").write.parquet(str(tmp_path / "index"))
    out = io.StringIO()
    assert cli.main(["validate", "--tables", str(tmp_path)], spark, stdin=io.StringIO('["/docs/a", "x"]'), stdout=out) == 0
    assert [r["verdict"] for r in json.loads(out.getvalue())["rows"]] == ["valid", "unverifiable"]


def test_cli_seed_docs_and_live_answers(spark, tmp_path):
    repo = tmp_path / "repo"
    repo.mkdir()
    run = lambda *a: subprocess.run(["git", "-C", str(repo), "-c", "user.name=a", "-c", "user.email=a@b.c", *a], check=True, capture_output=True)
    run("init", "-q")
    for day, names in (("2024-01-01", ["a", "b"]), ("2024-01-08", ["b"])):
        (repo / "catalogue.json").write_text(json.dumps({"lastChecked": f"{day}T01:02:03Z", "modules": [{"uid": n, "path": f"/training/modules/{n}", "unitUrls": [f"/training/modules/{n}/1-x"]} for n in names]}))
        run("add", "-A")
        run("commit", "-qm", day)
    folder = tmp_path / "ledger"
    folder.mkdir()
    tables = str(tmp_path / "tables")
    spark.createDataFrame([("/training/modules/b", ["/training/modules/b/1-x"], None)], "path string, unitUrls array<string>, hierarchyNotFound boolean").write.parquet(f"{tables}/modules")
    (tmp_path / "links.txt").write_text("# links\n/training/modules/z\n\n/training/modules/b\n")
    base = ["seed", "--tables", tables, "--ledger", str(folder), "--today", "2024-02-01", "--history", f"{repo}::catalogue.json", "--urls", str(tmp_path / "links.txt"), "--no-probe"]
    out = io.StringIO()
    assert cli.main([*base, "--dry-run"], spark, stdout=out) == 0
    assert "dry run" in out.getvalue() and "added:unverified: 3" in out.getvalue() and not list(folder.iterdir())
    assert cli.main(base, spark, stdout=io.StringIO()) == 0
    assert {(r.path, r.firstSeen) for r in files.read_ledger(spark, str(folder)).collect()} == {("/training/modules/a", "2024-01-08"), ("/training/modules/a/1-x", "2024-01-08"), ("/training/modules/z", "2024-02-01")}
    assert cli.main([*base, "--min-modules", "5"], spark, stdout=io.StringIO()) == 2
    assert cli.main([*base, "--max-probes", "-1"], spark, stdout=io.StringIO()) == 2
    assert cli.main([*base[:-3], "--history", "nowhere"], spark, stdout=io.StringIO()) == 2

    spark.createDataFrame([("/docs/a", "https://site.example/docs/a", "2024-01-01"), ("/docs/b", "https://site.example/docs/b", "2024-01-01")], "path string, url string, lastmod string").write.parquet(f"{tables}/rows")
    spark.createDataFrame([("/docs/a", "live", 200, None, "A", False)], "path string, outcome string, status int, to string, title string, noindex boolean").write.parquet(f"{tables}/results")
    out = io.StringIO()
    assert cli.main(["docs", "--tables", tables, "--ledger", str(folder), "--today", "2024-02-01", "--out", str(tmp_path / "new")], spark, stdout=out) == 0
    assert "new: 2" in out.getvalue() and "fetch: 2" in out.getvalue() and "pendingNew: 1" in out.getvalue()
    assert [(r.path, r.title, r.checked) for r in spark.read.parquet(str(tmp_path / "new/catalogue")).collect()] == [("/docs/a", "A", "2024-02-01")]
    assert cli.main(["docs", "--tables", str(tmp_path), "--ledger", str(folder), "--today", "2024-02-01"], spark, stdout=io.StringIO()) == 2

    answers = str(tmp_path / "answers")
    spark.createDataFrame([("/training/modules/q", "ok", None)], "path string, live_verdict string, live_to string").write.parquet(answers)
    out = io.StringIO()
    assert cli.main(["validate", "/training/modules/q", "/training/modules/w", "--tables", tables, "--confirm-live", answers], spark, stdout=out) == 1
    assert [r["verdict"] for r in json.loads(out.getvalue())["rows"]] == ["valid", "broken"]


def test_records_in_normal_form(spark):
    rows = spark.createDataFrame([("https://h/a", None, "x", "", 404, "k")], "url string, title string, zeta string, checked string, status int, alpha string")
    out = records.normal_record(rows)
    assert out.columns == [*records.RECORD, "alpha", "status", "zeta"] and (out.first().title, out.first().checked) == ("", None)
    assert records.strip_quarantine(rows).columns == ["url", "title", "zeta", "alpha"] and "checked" not in records.strip_checked(rows).columns
    assert records.is_object(spark.createDataFrame([((1,),)], "a struct<b:int>"), "a") and not records.is_object(rows, "url")
    texts = spark.createDataFrame([('{"modules": [{"uid": "u", "title": " ", "url": "https://h/en-us/M/a/"}, {"uid": 3}], "outOfScope": ["/x/", ""]}', "2024-01-01T00:00:00"), ('{"modules": 3}', None), ("no", None)], "content string, time string")
    (one,) = records.compact_snapshots(texts).collect()
    assert (one.path, one.title, one.units, one.lastChecked, one.out_of_scope) == ("/m/a", None, None, "2024-01-01T00:00:00", ["/x"])
    a = rows.withColumn("checked", F.lit("2024-01-01"))
    assert records.stable_signature(a) == records.stable_signature(rows.select(*reversed(rows.columns))) != records.stable_signature(rows.withColumn("zeta", F.lit("y")))
    made = json.loads("".join(r.value for r in records.envelope(rows.select("url", "alpha"), "url", "now", scope="s").collect()))
    assert made == {"generatedAt": "now", "scope": "s", "count": 1, "entries": [{"url": "https://h/a", "alpha": "k"}]}
    assert rows.select(records.snippet("url", 5).alias("s")).first().s == "https"
    said = []
    log = probes.RetryLog(said.append, "x", first=2, every=3)
    for i in range(7):
        log(str(i))
    assert len(said) == 4 and said[0] == "x: 0"
    try:
        raise OSError("outer") from ValueError("inner")
    except OSError as e:
        assert probes.describe_error(e) == "outer (inner)"
