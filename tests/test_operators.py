import subprocess

import pytest

from tidemark.config import GateFailure, LedgerError, UsageError
from tidemark.operators import ledger as L
from tidemark.operators import quality as Q
from tidemark.operators import queues
from tidemark.operators.dedupe import same_rows
from tidemark.operators.joins import lookup_changes
from tidemark.plans import report, validate
from tidemark.sources import files, probes
from tidemark.sources.git_history import GitHistory, parse_spec


def entry(path, file="moved", to=None, kind="docs", outcome=None, seen="2024-01-01", verified="2024-01-01", evidence="docs-redirect"):
    return (file, path, kind, "docs" if kind == "docs" else "learn", outcome or ("moved" if file == "moved" else "gone"), to, None, None, seen, verified, evidence, 301)


def make(spark, *rows):
    return spark.createDataFrame(list(rows), L.ENTRY)


def test_chase(spark):
    rows = [entry("/a", to="/b"), entry("/b", to="/c"), entry("/c", "removed"), entry("/x", to="/y"), entry("/y", to="/x"), entry("/off")]
    rows += [entry(f"/h{i}", to=f"/h{i + 1}") for i in range(9)]
    rows += [entry("/training/modules/m", to="/training/modules/n", kind="module"), entry("/training/modules/g", "removed", kind="module", outcome="landing", to="/training"), entry("/docs/p", to="/docs/q")]
    links = ["/a", "/b", "/c", "/x", "/off", "/h0", "/h5", "/training/modules/m/1-u", "/training/modules/g/2-u", "/training/modules/g", "/docs/p/child", "/none", "/"]
    got = {r.link: r for r in lookup_changes(spark.createDataFrame([(x,) for x in links], "path string"), make(spark, *rows)).collect()}
    s = lambda k: (got[k].state, got[k].outcome, got[k].confidence, got[k].to)
    assert s("/a") == ("removed", "gone", "high", None) and got["/a"].chain == ["/a", "/b", "/c"] and got["/a"].entry_path == "/a" and got["/a"].final_path == "/c"
    assert s("/x") == ("moved", "moved", "low", "/x") and got["/x"].cycle
    assert s("/off") == ("moved", "moved", "high", None)
    assert s("/h0") == ("moved", "moved", "low", "/h5") and got["/h0"].truncated and len(got["/h0"].chain) == 6
    assert s("/h5") == ("moved", "moved", "high", "/h9") and not got["/h5"].truncated
    assert s("/training/modules/m/1-u") == ("moved", "moved", "low", "/training/modules/n/1-u") and got["/training/modules/m/1-u"].match == "ancestor"
    assert s("/training/modules/g/2-u") == ("removed", "landing", "high", None)
    assert s("/training/modules/g") == ("removed", "landing", "high", "/training")
    assert set(got) == set(links) - {"/docs/p/child", "/none", "/"}


def test_ledger_rules(spark):
    raw = make(spark, entry("https://h/en-us/A/"), entry("/a", verified="2024-02-01", seen="2024-01-15"), entry("/bad", outcome="gone"), entry("/b", "removed", seen="2024-2-1"), entry("/c", "removed", evidence="x"), entry("/"))
    good = {r.path: r for r in L.normal_ledger(raw).collect()}
    assert set(good) == {"/a"} and good["/a"].firstSeen == "2024-01-01" and good["/a"].lastVerified == "2024-02-01"
    with pytest.raises(LedgerError):
        L.normal_ledger(raw, strict=True)


def test_apply_is_idempotent_and_covers_units(spark):
    none = spark.createDataFrame([], "path string, outcome string, to string, status int")
    new = spark.createDataFrame([("/training/modules/m", "module", None, "M", "tombstone", "2024-01-05"), ("/training/modules/m/1", "unit", "/training/modules/m", None, "unit-diff", "2024-01-05"), ("/training/modules/k/1", "unit", "/training/modules/k", None, "unit-diff", "2024-01-05"), ("/docs/x", "docs", None, None, "quarantine", "2024-01-05")], "path string, kind string, parent string, title string, evidence string, firstSeen string")
    live = spark.createDataFrame([], "path string")
    start = make(spark, entry("/docs/d"))
    one = L.apply_changes(start, new, none, live, "learn", "2024-01-06")
    assert sorted((r.path, r.outcome) for r in one.collect()) == [("/docs/d", "moved"), ("/training/modules/k/1", "unverified"), ("/training/modules/m", "unverified"), ("/training/modules/m/1", "unverified")]
    assert same_rows(one, L.apply_changes(one, new, none, live, "learn", "2024-01-07"))
    told = spark.createDataFrame([("/training/modules/m", "gone", None, 404), ("/training/modules/k/1", "transient", None, 503)], none.schema)
    two = L.apply_changes(one, new, told, live, "learn", "2024-01-08")
    assert sorted((r.path, r.outcome, r.lastVerified) for r in two.where("family = 'learn'").collect()) == [("/training/modules/k/1", "unverified", None), ("/training/modules/m", "gone", "2024-01-08")]
    back = spark.createDataFrame([("/training/modules/m",)], "path string")
    assert L.apply_changes(two, new.limit(0), none, back, "learn", "2024-01-09").where("kind = 'module'").count() == 0
    queue = [(r.path, r.reason) for r in queues.verification_queue(one, "2024-01-06").orderBy("queue_pos").collect()]
    assert queue == [("/training/modules/k/1", "unverified"), ("/training/modules/m", "unverified")]  # the module's unit waits
    asked = []

    def probe(q):
        asked.append(sorted(r.path for r in q.collect()))
        return spark.createDataFrame([(p, "gone", None, 404) for p in asked[-1]], none.schema)

    done = L.refresh(start, new, live, "learn", "2024-01-06", probe, 10)
    assert asked == [["/training/modules/k/1", "/training/modules/m"]] and done.where("outcome = 'unverified'").count() == 0
    assert {(r.change, r.n) for r in L.compared(one, two).collect()} == {("dropped", 1), ("reclassified", 1), ("kept", 2)}


def test_ledger_files(spark, tmp_path):
    rows = make(spark, entry("/b", to="/c"), entry("/a", to=None), entry("/r", "removed"))
    folder = str(tmp_path)
    L_ = L.normal_ledger(rows)
    files.write_ledger(L_, folder, "2024-01-01T00:00:00Z")
    assert same_rows(files.read_ledger(spark, folder), L_) and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["moved.json", "removed.json"]
    (tmp_path / "moved.json").write_text('{"schemaVersion": 9, "entries": []}')
    with pytest.raises(LedgerError):
        files.read_ledger(spark, folder)


def test_index_and_tables(spark, tmp_path):
    index = spark.createDataFrame([("/b", None), ("/a", "2024-01-01")], "path string, lastmod string")
    path = str(tmp_path / "urls.txt")
    files.write_index(index, path)
    assert (tmp_path / "urls.txt").read_text() == "/a\t2024-01-01\n/b\t-\n" and same_rows(files.read_index(spark, path), index)
    for bad in ("/A\t-\n", "/a\t-\n/a\t-\n"):
        (tmp_path / "bad.txt").write_text(bad)
        with pytest.raises(ValueError):
            files.read_index(spark, str(tmp_path / "bad.txt"))
    table = str(tmp_path / "t")
    assert files.write_if_changed(index, table) and not files.write_if_changed(index.orderBy("path"), table) and files.write_if_changed(index.limit(1), table)
    (tmp_path / "md/includes").mkdir(parents=True)
    (tmp_path / "md/x.md").write_text("---\ntitle: X\n---\nb")
    (tmp_path / "md/includes/y.md").write_text("---\ntitle: Y\n---\nb")
    md = files.read_markdown(spark, str(tmp_path / "md"))
    assert [(r.url, r.title) for r in files.git_records(md, "", "docs", "d.example").collect()] == [("https://d.example/docs/x", "X")]


def test_git_history(spark, tmp_path):
    run = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=a", "-c", "user.email=a@b.c", *a], check=True, capture_output=True)
    run("init", "-q")
    for text in ("one", "two"):
        (tmp_path / "f.json").write_text(text)
        run("add", "f.json")
        run("commit", "-qm", text)
    spark.dataSource.register(GitHistory)
    rows = spark.read.format("git_history").option("specs", f"{tmp_path}::f.json").load().orderBy("ord").collect()
    assert [(r.ord, r.content) for r in rows] == [(0, "one"), (1, "two")]
    with pytest.raises(ValueError):
        parse_spec("x")


def test_gates(spark):
    Q.enforce(Q.floor_gate(spark, "n", 5, 5), Q.drop_gate(spark, "d", 100, 95, 5), Q.ratio_gate(spark, "r", 3, 4, 10, least_sample=5))
    with pytest.raises(GateFailure) as e:
        Q.enforce(Q.floor_gate(spark, "n", 4, 5), Q.ratio_gate(spark, "r", 3, 4, 10))
    assert len(e.value.problems) == 2
    assert Q.size_floor(100_000) == 60_000 and Q.size_floor(10) == 20_000 and Q.index_baseline(0, 7)[2] == "catalogue"
    assert Q.breaker(50, 26) and not Q.breaker(50, 25) and not Q.breaker(49, 49)
    s = Q.Streak(2)
    assert [s.add(x) for x in (True, False, True, True)] == [False, False, False, True]
    assert queues.split_budget(10, 20, 20) == (8, 2) and queues.split_budget(10, 3, 20) == (3, 7) and queues.split_budget(0, 1, 1) == (0, 0)


def test_reports(spark):
    ledger = make(spark, entry("/a", to="/b"), entry("/c", "removed", seen="2024-03-01"))
    assert [r.path for r in report.changelog(ledger, "2024-02-01").collect()] == ["/c"]
    with pytest.raises(UsageError):
        report.changelog(ledger, "soon")
    links = spark.createDataFrame([("https://h/a",), ("/zzz",)], "url string")
    assert {(r.path, r.status) for r in report.check_links(links, ledger).collect()} == {("/a", "moved"), ("/zzz", "none")}
    assert report.with_section({"b": {}}, "a", {"n": 1}, "t") == {"schemaVersion": 1, "a": {"generatedAt": "t", "runId": None, "n": 1}, "b": {}}
    results = spark.createDataFrame([("/a", "broken", None, None), ("/c", "broken", None, None), ("/q", "valid", None, None)], "path string, verdict string, redirects_to string, suggestion string")
    out = {r.path: r for r in validate.enriched(results, ledger).collect()}
    assert out["/a"].redirects_to == "/b" and out["/a"].suggestion == "https://site.example/b" and out["/c"].change.state == "removed" and out["/q"].change is None


def test_missing_caches_are_unverifiable(spark):
    links = spark.createDataFrame([("/docs/x",), ("/training/modules/a",), ("/training/modules/a/1",), ("/training/courses/c",), ("x",), ("/shows/s",)], "url string")
    got = {r.url: r.verdict for r in validate.validate(links, validate.Caches()).collect()}
    assert got == {"/docs/x": "unverifiable", "/training/modules/a": "unverifiable", "/training/modules/a/1": "unverifiable", "/training/courses/c": "unverifiable", "x": "unverifiable", "/shows/s": "unverifiable"}


def test_probing_with_a_transport(spark):
    site = {"https://h.example/a": (301, {"location": "/b"}, ""), "https://h.example/b": (200, {}, "<title> B\n b</title>"), "https://h.example/o": (302, {"location": "https://o.example/"}, ""), "https://h.example/l": (302, {"location": "/l"}, "")}

    def transport(url):
        if url.endswith("/down"):
            raise OSError("down")
        return site.get(url, (404, {}, ""))

    p = lambda path: probes.probe_page(f"https://h.example{path}", "h.example", transport, retries=1, sleep=lambda _: None)
    assert (p("/a")["status"], p("/a")["firstStatus"], p("/a")["finalUrl"], p("/a")["title"]) == (200, 301, "https://h.example/b", "B b")
    assert p("/o")["offsite"] and p("/down")["error"] == "down" and "redirects" in p("/l")["error"] and p("/zz")["status"] == 404
    queue = spark.createDataFrame([("/a",), ("/zz",)], "path string")
    assert {(r.path, r.status) for r in probes.fetch(queue, "h.example", transport, pause=0).collect()} == {("/a", 200), ("/zz", 404)}


def test_replay(spark, tmp_path):
    from tidemark.streaming.replay import replay, sessions

    schema = "path string, kind string, outcome string, to string, status int"
    src = str(tmp_path / "in")
    spark.createDataFrame([("/training/modules/a", "module", "gone", None, 404), ("/training/modules/b", "module", "live", None, 200)], schema).coalesce(1).write.parquet(src)
    replay(spark, spark.readStream.schema(schema).parquet(src), str(tmp_path / "t"), str(tmp_path / "c"), "learn", "2024-01-01").awaitTermination(60)
    assert [(r.path, r.outcome) for r in spark.read.parquet(str(tmp_path / "t/v1")).collect()] == [("/training/modules/a", "gone")]
    e = spark.createDataFrame([("2024-01-01 00:00:00", 1), ("2024-01-01 00:10:00", 1), ("2024-01-01 02:00:00", 1)], "ts string, u int")
    assert sorted(r.n for r in sessions(e, "ts", "u").collect()) == [1, 2]
