"""The sidebar run against the cases it must hold."""

import json

import pytest

from tidemark.config import GateFailure
from tidemark.plans import sidebars
from tidemark.plans.sidebars import NONE, TOCS, SidebarLimits, sidebar_run

D1, D2, D3 = "2026-10-05", "2026-10-12", "2026-11-20"
PAGES = {"/azure/vm": 4, "/entra/fundamentals": 3, "/entra/identity": 3, "/entra/identity/users": 3, "/azure/few": 2}


def toc(*groups):
    return json.dumps({"items": [{"toc_title": t, "children": [{"href": h, "toc_title": h} for h in hrefs]} for t, *hrefs in groups]})


@pytest.fixture
def site(spark):
    class Site:
        answers = {"/azure/vm": toc(("VMs", "v1", "v2")), "/entra/fundamentals": toc(("Start", "a", "b")), "/entra/identity/users": toc(("Users", "u"), ("More", "../x.md", "/Other/Y/"))}

        def __init__(self):
            self.answers, self.calls, self.pages = dict(Site.answers), [], dict(PAGES)
            self.tocs, self.none = spark.createDataFrame([], TOCS), spark.createDataFrame([], NONE)

        def ask(self, queue):
            self.calls = [r.folder for r in queue.orderBy("queue_pos").collect()]
            rows = []
            for f in self.calls:
                a = self.answers.get(f)
                rows.append((f, "notFound" if a is None else "ok" if isinstance(a, str) else "failed", a if isinstance(a, str) else None))
            return spark.createDataFrame(rows, "folder string, outcome string, toc string")

        def run(self, today=D1, keep=True, **more):
            index = spark.createDataFrame([(f"{f}/p{i}",) for f, n in self.pages.items() for i in range(n)] + [("/top",), ("/entra/x",)], "path string")
            out = sidebar_run(index, self.tocs, self.none, self.ask, today, **more)
            if keep:
                self.tocs, self.none = out.tocs, out.none
            self.by = {r.toc: r for r in out.tocs.collect()}
            self.without = {r.folder: r.day for r in out.none.collect()}
            return out

    return Site()


def test_a_first_run_asks_all_folders_with_enough_pages(site):
    out = site.run()
    assert site.calls == ["/azure/vm", "/entra/fundamentals", "/entra/identity", "/entra/identity/users"]
    assert set(site.by) == {"/azure/vm", "/entra/fundamentals", "/entra/identity/users"} and site.without == {"/entra/identity": D1}
    users = site.by["/entra/identity/users"]
    assert [(list(g.title), g.landing, list(g.pages)) for g in users.groups] == [(["Users"], None, ["/entra/identity/users/u"]), (["More"], None, ["/entra/identity/x", "/other/y"])]
    assert (users.since, users.pages, out.asked, out.failed, out.unchanged) == (D1, 3, 4, 0, False)


def test_a_quiet_second_run_asks_known_sidebars_only(site):
    site.run()
    first = site.by
    out = site.run(D2)
    assert site.calls == ["/azure/vm", "/entra/fundamentals", "/entra/identity/users"] and out.unchanged and site.by == first and site.without == {"/entra/identity": D1}


def test_changed_gone_new_and_due(site):
    site.run()
    old = site.by
    site.answers["/azure/vm"] = toc(("VMs", "v1", "v3"))
    del site.answers["/entra/identity/users"]
    site.answers["/entra/identity"] = toc(("Identity", "p"))
    out = site.run(D3)
    assert site.by["/azure/vm"].sig != old["/azure/vm"].sig and site.by["/azure/vm"].since == D3 and site.by["/azure/vm"].groups[0].pages == ["/azure/vm/v1", "/azure/vm/v3"]
    assert site.by["/entra/fundamentals"].since == D1 and set(site.by) == {"/azure/vm", "/entra/fundamentals", "/entra/identity"}
    assert site.without == {"/entra/identity/users": D3} and not out.unchanged


def test_failed_and_unasked_folders_keep_their_sidebars(site):
    site.run()
    site.answers["/azure/vm"] = 503
    out = site.run(D2)
    assert "/azure/vm" in site.by and out.failed == 1
    site.ask, asked = (lambda queue: queue.where("folder = '/azure/vm'").selectExpr("folder", "'ok' as outcome", f"'{toc(('VMs', 'new'))}' as toc")), site.ask
    out = site.run(D2)
    assert set(site.by) == {"/azure/vm", "/entra/fundamentals", "/entra/identity/users"} and out.asked == 1 and site.without == {"/entra/identity": D1}
    assert asked


def test_dropped_folders_go(site):
    site.run()
    del site.pages["/azure/vm"], site.pages["/entra/identity"]
    site.run(D2)
    assert set(site.by) == {"/entra/fundamentals", "/entra/identity/users"} and site.without == {}


@pytest.mark.parametrize(("bad", "word"), [(503, "failed requests"), ("<html>sign in</html>", "failed requests"), ('{"navigation": []}', "table of contents")])
def test_bad_answers_stop_the_run(site, bad, word):
    for f in site.answers:
        site.answers[f] = bad
    with pytest.raises(GateFailure, match=word):
        site.run(limits=SidebarLimits(least_sample=2))


def test_lost_pages_and_the_breaker_stop_the_run(site):
    site.run()
    for f in ("/azure/vm", "/entra/fundamentals"):
        site.answers[f] = toc()
    site.answers["/entra/identity/users"] = toc(("Users", "x"))
    with pytest.raises(GateFailure, match="pages in a sidebar group"):
        site.run(D2, keep=False, limits=SidebarLimits(least_before=3))
    site.answers = dict.fromkeys(site.answers, 503)
    with pytest.raises(GateFailure, match="stopped after 2 requests"):
        site.run(D2, keep=False, limits=SidebarLimits(breaker=2, chunk=2, least_sample=99))


def test_scopes_and_budgets(site):
    site.run(families=["azure"])
    assert list(site.by) == ["/azure/vm"]
    site.run(D2, same_scope=False)
    assert len(site.calls) == 4 and site.by["/azure/vm"].since == D2
    out = site.run(D1, same_scope=False, limits=SidebarLimits(probes=2))
    assert (out.asked, out.waiting) == (2, 2)


def test_trees(spark):
    tree = {"items": [{"href": "top", "toc_title": "T"}, {"href": "top"}, {"toc_title": " A \n b ", "href": "land", "children": [{"href": "x"}, {"toc_title": "C", "children": [{"href": "y"}]}, {"href": "z"}]}, {"toc_title": "empty", "children": []}, {"href": "mailto:a@b"}, 3, None]}
    rows = [("/d", "ok", json.dumps(tree)), ("/e", "ok", "[]"), ("/f", "ok", None), ("/g", "notFound", None), ("/h", None, None), ("/i", "ok", '{"items": []}')]
    got = {r.folder: r for r in sidebars.parsed(spark.createDataFrame(rows, "folder string, outcome string, toc string")).collect()}
    assert {f: r.outcome for f, r in got.items()} == {"/d": "ok", "/e": "malformed", "/f": "failed", "/g": "none", "/h": "failed", "/i": "ok"}
    assert [(list(g.title), g.landing, list(g.pages)) for g in got["/d"].groups] == [([], None, ["/d/top"]), (["A b"], "/d/land", ["/d/x", "/d/z"]), (["A b", "C"], None, ["/d/y"])]
    assert got["/i"].groups == []
