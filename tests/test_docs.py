"""Cases of the documentation plan and of its reconciliation, as tables."""

import pytest

from tidemark.config import Limits, Scope, Site
from tidemark.operators import docs
from tidemark.operators import ledger as L
from tidemark.plans import runs

SITE = Site(host="h", learn=Scope(("/docs",), ("/docs/internal",)), index=Scope(("/ref",)))
TODAY = "2024-03-01"
ROW, RECORD = "path string, url string, lastmod string", "path string, url string, title string, lastmod string, checked string, stamped boolean"
HELD = "path string, url string, title string, status int, firstDetected string, lastChecked string"
RESULT = "path string, outcome string, status int, to string, title string, noindex boolean"


def row(path, lastmod="2024-02-01", url=None):
    return (path, url or f"https://h{path}", lastmod)


def rec(path, title="T", lastmod="2024-02-01", checked="2024-01-10", url=None, stamped=True):
    return (path, url or f"https://h{path}", title, lastmod, checked, stamped)


def held(path, title="Q", status=404, first="2024-01-01", last="2024-02-01"):
    return (path, f"https://h{path}", title, status, first, last)


def answer(path, outcome, status=None, to=None, title=None, noindex=None):
    return (path, outcome, status, to, title, noindex)


def planned(spark, rows=(), catalogue=(), index=None, quarantine=(), redirects=(), ok=True):
    index = [(r[0], r[2]) for r in rows] if index is None else index
    make = spark.createDataFrame
    return docs.plan(make(list(rows), ROW), make(list(catalogue), RECORD), make(list(index), "path string, lastmod string"), make(list(quarantine), HELD), make(list(redirects), "`from` string, lastSeen string"), TODAY, SITE, 30, ok)


def run(spark, results, **kw):
    return {r.path: r for r in docs.reconcile(planned(spark, **kw), spark.createDataFrame(list(results), RESULT), TODAY, SITE).collect()}


def actions(df):
    return {r.path: (r.action, r.reason) if r.reason else r.action for r in df.collect()}


def test_kept_changed_new_bootstrapped_untitled(spark):
    rows = [row("/docs/k"), row("/docs/c", "2024-02-09"), row("/docs/n"), row("/docs/b"), row("/docs/u"), row("/docs/z", None)]
    catalogue = [rec("/docs/k"), rec("/docs/c"), rec("/docs/b", lastmod=None, stamped=False), rec("/docs/u", title=None), rec("/docs/z", lastmod=None)]
    assert actions(planned(spark, rows, catalogue)) == {"/docs/k": "kept", "/docs/c": ("changed", "lastmod"), "/docs/n": "new", "/docs/b": "bootstrapped", "/docs/u": ("changed", "untitled"), "/docs/z": "kept"}
    out = run(spark, [], rows=rows, catalogue=catalogue)
    assert out["/docs/b"].lastmod == "2024-02-01" and out["/docs/b"].in_catalogue


def test_index_only_quarantined_and_out_of_scope(spark):
    rows = [row("/ref/a"), row("/docs/q"), row("/docs/internal/x")]
    out = planned(spark, rows, [rec("/docs/internal/y"), rec("/ref/r")], index=[("/ref/gone", None), ("/other", None)], quarantine=[held("/docs/q")])
    assert actions(out) == {"/ref/a": "index-only", "/docs/q": "quarantined", "/docs/internal/x": "out-of-scope", "/ref/gone": "missing", "/other": "out-of-scope"}


def test_case_variants_fold_into_the_listed_spelling(spark):
    twice = [rec("/docs/a", url="https://h/Docs/A"), rec("/docs/a", url="https://h/docs/a", lastmod="2024-01-01")]
    out = planned(spark, [row("/docs/a", "2024-01-01")], twice).collect()
    assert [(r.action, r.url) for r in out] == [("kept", "https://h/docs/a")]
    assert [r.url for r in planned(spark, [row("/docs/a", url="https://h/docs/A")], [rec("/docs/a")]).collect()] == ["https://h/docs/A"]


def test_known_redirects_are_not_read_for_thirty_days(spark):
    rows, seen = [row("/docs/r")], lambda day: [("/docs/r", day)]
    assert actions(planned(spark, rows, redirects=seen("2024-02-20"))) == {"/docs/r": "redirecting"}
    assert actions(planned(spark, rows, redirects=seen("2024-01-31"))) == {"/docs/r": "new"}
    assert actions(planned(spark, rows, redirects=seen("2024-02-20"), index=[("/docs/x", None)])) == {"/docs/r": "new", "/docs/x": "missing"}  # it has just appeared
    assert actions(planned(spark, rows, redirects=seen("2024-02-20"), index=[])) == {"/docs/r": "redirecting"}  # no index before: nothing is known


def test_failed_sitemaps_turn_removal_off(spark):
    kw = dict(rows=[row("/docs/k")], catalogue=[rec("/docs/k"), rec("/docs/lost", lastmod="2024-01-05")], index=[("/docs/k", None), ("/docs/lost", "2024-01-06"), ("/docs/bare", None)], ok=False)
    assert actions(planned(spark, **kw)) == {"/docs/k": "kept", "/docs/lost": "carried", "/docs/bare": "carried"}
    out = run(spark, [answer("/docs/lost", "gone", 404)], **kw)
    assert out["/docs/lost"].in_index and out["/docs/lost"].index_lastmod == "2024-01-06" and out["/docs/lost"].in_catalogue and not out["/docs/lost"].quarantined
    assert out["/docs/bare"].in_index and not out["/docs/bare"].in_catalogue


def state(r):
    return r.state, r.in_index, r.in_catalogue, r.quarantined, r.contradicted


@pytest.mark.parametrize(
    "result, want_new, want_changed",
    [
        (answer("/docs/p", "live", 200, title="New"), ("read", True, True, False, True), ("read", True, True, False, True)),
        (answer("/docs/p", "gone", 404), ("not-yet-there", True, False, False, True), ("quarantined", False, False, True, True)),
        (answer("/docs/p", "moved", 301, "/docs/t"), ("moved", True, False, False, False), ("moved", True, False, False, False)),
        (answer("/docs/p", "transient", 503), ("transient", True, False, False, False), ("transient", True, True, False, False)),
        (answer("/docs/other", "live", 200), ("untouched", True, False, False, False), ("untouched", True, True, False, False)),
        (answer("/docs/p", "live", 200, title="New", noindex=True), ("noindex", True, False, False, True), ("noindex", True, False, False, True)),
        (answer("/docs/p", "live", 200, title=""), ("untitled", True, False, False, True), ("kept-title", True, True, False, True)),
    ],
)
def test_fetch(spark, result, want_new, want_changed):
    rows = [row("/docs/p", "2024-02-20")]
    new = run(spark, [result], rows=rows)["/docs/p"]
    assert state(new) == want_new
    old = run(spark, [result], rows=rows, catalogue=[rec("/docs/p")])["/docs/p"]
    assert state(old) == want_changed
    if old.state == "read":
        assert (old.title, old.lastmod, old.checked, old.index_lastmod) == ("New", "2024-02-20", TODAY, "2024-02-20")
    elif old.in_catalogue:
        assert (old.title, old.lastmod, old.checked) == ("T", "2024-02-01", "2024-01-10")  # the old lastmod: it is queued again
    if old.quarantined:
        assert (old.title, old.status, old.firstDetected, old.lastChecked) == ("T", 404, TODAY, TODAY)
    if old.state == "moved":
        assert (old.moved_to, old.moved_status) == ("/docs/t", 301)


def test_an_untitled_record_is_repaired(spark):
    out = run(spark, [answer("/docs/u", "live", 200, title="Now")], rows=[row("/docs/u")], catalogue=[rec("/docs/u", title=None)])["/docs/u"]
    assert (out.state, out.title, out.checked) == ("read", "Now", TODAY)
    assert state(run(spark, [answer("/docs/u", "live", 200)], rows=[row("/docs/u")], catalogue=[rec("/docs/u", title=None)])["/docs/u"])[:3] == ("untitled", True, False)


@pytest.mark.parametrize("outcome, want", [("live", ("confirmed", True, True, False, True)), ("gone", ("quarantined", False, False, True, True)), ("moved", ("moved", True, False, False, False)), ("transient", ("transient", True, True, False, False))])
def test_verify(spark, outcome, want):
    out = run(spark, [answer("/docs/k", outcome, 410)], rows=[row("/docs/k")], catalogue=[rec("/docs/k")])["/docs/k"]
    assert state(out) == want and out.checked == (TODAY if outcome == "live" else "2024-01-10")


@pytest.mark.parametrize(
    "outcome, with_record, bare",
    [
        ("live", ("confirmed", True, True, False, True), ("confirmed", True, False, False, True)),
        ("gone", ("quarantined", False, False, True, True), ("quarantined", False, False, True, True)),
        ("moved", ("moved", False, False, False, False), ("moved", False, False, False, False)),
        ("transient", ("transient", True, True, False, False), ("transient", True, False, False, False)),
        (None, ("untouched", True, True, False, False), ("untouched", True, False, False, False)),
    ],
)
def test_missing(spark, outcome, with_record, bare):
    results = [answer(p, outcome, 404) for p in ("/docs/m", "/docs/bare")] if outcome else []
    out = run(spark, results, rows=[row("/docs/k")], catalogue=[rec("/docs/m", lastmod="2024-01-05")], index=[("/docs/k", None), ("/docs/m", "2024-01-06"), ("/docs/bare", "2024-01-07")])
    assert state(out["/docs/m"]) == with_record and state(out["/docs/bare"]) == bare
    if out["/docs/bare"].in_index:
        assert (out["/docs/m"].index_lastmod, out["/docs/bare"].index_lastmod) == ("2024-01-06", "2024-01-07")
    if out["/docs/bare"].quarantined:
        assert out["/docs/bare"].title is None and out["/docs/m"].title == "T"


def test_quarantine(spark):
    rows = [row("/docs/back"), row("/docs/still"), row("/docs/untitled")]
    q = [held("/docs/back"), held("/docs/still", status=404), held("/docs/away"), held("/docs/flaky"), held("/docs/unasked"), held("/docs/untitled", title=None), held("/ref/back")]
    answers = [answer("/docs/back", "live", 200), answer("/docs/still", "gone", 410), answer("/docs/away", "moved", 301, "/docs/t"), answer("/docs/flaky", "transient", 500), answer("/docs/untitled", "live", 200), answer("/ref/back", "live", 200)]
    out = run(spark, answers, rows=rows, quarantine=q)
    back = out["/docs/back"]
    assert state(back) == ("released", True, True, False, True) and (back.title, back.lastmod, back.checked, back.index_lastmod) == ("Q", docs.RELEASED, TODAY, "2024-02-01")
    still = out["/docs/still"]
    assert state(still) == ("still-gone", False, False, True, False) and (still.status, still.firstDetected, still.lastChecked) == (410, "2024-01-01", TODAY)
    assert state(out["/docs/away"]) == ("moved", False, False, False, False) and out["/docs/away"].moved_to == "/docs/t"
    for p in ("/docs/flaky", "/docs/unasked"):
        assert state(out[p])[1:] == (False, False, True, False) and (out[p].status, out[p].lastChecked) == (404, "2024-02-01")
    assert state(out["/docs/untitled"])[:3] == ("released", True, False)
    assert state(out["/ref/back"])[:3] == ("released", True, False)  # no records in that scope
    two = [held("/docs/x", first="2024-01-01", last="2024-01-09", status=410), held("/docs/x", first="2023-12-01", last="2024-01-02")]
    one = run(spark, [], quarantine=two)["/docs/x"]
    assert (one.firstDetected, one.lastChecked, one.status) == ("2023-12-01", "2024-01-09", 410)


def test_queues_within_their_budgets(spark):
    rows = [row(f"/docs/n{i}", f"2024-02-0{i}") for i in range(1, 8)] + [row(f"/docs/c{i}", f"2024-02-1{i}") for i in range(1, 8)] + [row(f"/docs/k{i}") for i in range(3)]
    catalogue = [rec(f"/docs/c{i}") for i in range(1, 8)] + [rec(f"/docs/k{i}", checked=[None, "2024-01-03", "2024-01-02"][i]) for i in range(3)] + [rec("/docs/m1", checked="2024-01-02"), rec("/docs/m2", checked="2024-01-01")]
    index = [(r[0], r[2]) for r in rows] + [("/docs/m1", None), ("/docs/m2", None), ("/docs/b1", None), ("/docs/b2", None)]
    p = planned(spark, rows, catalogue, index, [held("/docs/q1", last="2024-02-02"), held("/docs/q2", last="2024-02-01")])
    got = {(r.phase, r.path) for r in runs.queue_budget(p, Limits(page_fetches=5, verify=2, missing_checks=2, quarantine_rechecks=1), TODAY).collect()}
    assert {x for x in got if x[0] == "fetch"} == {("fetch", f"/docs/c{i}") for i in (7, 6, 5, 4)} | {("fetch", "/docs/n7")}
    assert {x for x in got if x[0] == "verify"} == {("verify", "/docs/k0"), ("verify", "/docs/k2")}
    assert ("missing", "/docs/m2") in got and sum(x[0] == "missing" for x in got) == 2 and ("quarantine", "/docs/q2") in got
    assert runs.queue_budget(p, Limits(page_fetches=0, verify=0, missing_checks=0, quarantine_rechecks=0), TODAY).count() == 0


def test_redirects_follow_scope_and_reappearance(spark):
    make = spark.createDataFrame
    schema = "from string, to string, kind string, status int, firstSeen string, lastSeen string"
    old = make([("/docs/a", "/docs/b", "moved", 301, "2024-01-01", "2024-01-02"), ("/docs/back", "/docs/b", "moved", 301, "2024-01-01", "2024-01-02"), ("/docs/own", "/docs/b", "moved", 301, "2024-01-01", "2024-01-02"), ("/elsewhere", "/docs/b", "moved", 301, "2024-01-01", "2024-01-02")], schema)
    found = make([("/docs/a", "/docs/c", "moved", 302), ("/docs/self", "/docs/self", "moved", 301), ("/else", "/docs/c", "moved", 301)], "from string, to string, kind string, status int")
    paths = lambda *p: make([(x,) for x in p], "path string")
    out = L.update_redirects(old, found, paths("/docs/own"), paths("/docs/back", "/docs/a"), paths("/docs/a"), TODAY, (SITE.learn, SITE.index))
    assert {(r["from"], r.to, r.status, r.firstSeen, r.lastSeen) for r in out.collect()} == {("/docs/a", "/docs/c", 302, "2024-01-01", TODAY)}


def test_ledger_results_and_dates(spark):
    entry = lambda path, outcome, to, status, verified, title=None: ("removed" if outcome != "moved" else "moved", path, "module", "learn", outcome, to, title, None, "2024-01-01", verified, "tombstone", status)
    start = spark.createDataFrame([entry("/training/modules/p", "landing", "/training/browse", 200, "2024-01-20"), entry("/training/modules/r", "unverified", None, None, None), entry("/training/modules/g", "moved", "/x", 301, "2024-01-20")], L.ENTRY)
    candidates = spark.createDataFrame([("/training/modules/p", "module", "/parent", "Better", "hierarchy-not-found", "2023-06-01")], "path string, kind string, parent string, title string, evidence string, firstSeen string")
    results = spark.createDataFrame([("/training/modules/r", "retired", "https://h/en-us/Archive/R/", None), ("/training/modules/g", "gone", "/y", 404)], "path string, outcome string, to string, status int")
    none = spark.createDataFrame([], "path string")
    got = {r.path: r for r in L.apply_changes(start, candidates, results, none, "learn", TODAY, "h").collect()}
    p, q, g = (got[f"/training/modules/{x}"] for x in "prg")
    assert (p.outcome, p.title, p.parent, p.firstSeen, p.lastVerified, p.evidence) == ("landing", "Better", "/parent", "2024-01-01", "2024-01-20", "tombstone")
    assert (q.outcome, q.to, q.status, q.lastVerified, q.file) == ("retired", "/archive/r", None, TODAY, "removed")
    assert (g.outcome, g.to, g.status, g.file) == ("gone", None, 404, "removed")
    for family, today in (("other", TODAY), ("learn", "soon")):
        with pytest.raises(L.LedgerError):
            L.apply_changes(start, candidates, results, none, family, today)
