"""The module-link run against the cases it must hold."""

import pytest

from tidemark.config import GateFailure
from tidemark.operators import ledger
from tidemark.plans import module_links as ML
from tidemark.plans.validate import Caches

D1, D2, D3 = "2026-10-05", "2026-10-12", "2026-11-20"
P = "/training/modules/"
LINK = "array<struct<kind: string, path: string, url: string, text: string, section: string>>"


@pytest.fixture
def lab(spark):
    class Lab:
        def __init__(self):
            self.modules = {"a": "sig-a1", "b": "sig-b1", "c": "sig-c1"}
            self.scope = ["a", "b", "z"]
            self.pages = {"a": ["/docs/one", "/docs/two"], "b": ["/docs/b"], "c": ["/docs/c"]}
            self.index = ["/docs/one", "/docs/two", "/docs/b", "/docs/c", "/docs/new"]
            self.redirects, self.live, self.asked, self.checked = [], {}, [], []
            self.records, self.links = spark.createDataFrame([], ML.RECORDS), spark.createDataFrame([], ML.LINKS)
            self.full_at, self.first = None, True

        def fetch(self, queue):
            self.asked = [(r.path.removeprefix(P), r.unit) for r in queue.orderBy("queue_pos").collect()]
            rows = []
            for m, _ in self.asked:
                page = self.pages[m]
                links = [("external", None, x, "t", None) if x.startswith("http") else ("docs", x, None, "t", "s") for x in page] if isinstance(page, list) else None
                rows.append((P + m, "ok" if links is not None else page, "Summary", links))
            return spark.createDataFrame(rows, f"path string, outcome string, unitTitle string, links {LINK}")

        def probe(self, queue):
            self.checked = [r.path for r in queue.orderBy("queue_pos").collect()]
            return spark.createDataFrame([(p, *self.live.get(p, ("ok", None))) for p in self.checked], "path string, verdict string, redirects_to string")

        def run(self, today=D1, **more):
            modules = spark.createDataFrame([(P + m, [f"{P}{m}/1-x", f"{P}{m}/9-summary"] if s else [], s) for m, s in self.modules.items()], "path string, unitUrls array<string>, unitSig string")
            scope = spark.createDataFrame([(P + m,) for m in self.scope], "path string")
            caches = Caches(
                index=spark.createDataFrame([(p,) for p in self.index], "path string"),
                redirects=spark.createDataFrame(self.redirects, "from string, to string, kind string, firstSeen string"),
                ledger=spark.createDataFrame([], ledger.ENTRY),
            )
            out = ML.module_link_run(modules, scope, self.records, self.links, self.full_at, self.fetch, caches, self.probe, today, first=self.first, **more)
            self.records, self.links, self.full_at, self.first = out.records, out.links, out.full_at, False
            self.by = {r.path.removeprefix(P): r for r in out.records.collect()}
            self.to = {}
            for r in out.links.orderBy("module", "pos").collect():
                self.to.setdefault(r.module.removeprefix(P), []).append(r)
            return out

    return Lab()


def paths(links):
    return [r.path or r.url for r in links]


def test_a_first_run_is_a_full_pass(lab):
    out = lab.run()
    assert lab.asked == [("a", P + "a/9-summary"), ("b", P + "b/9-summary")] and lab.full_at == D1
    a = lab.by["a"]
    assert (a.unitSig, a.unit, a.unitTitle, a.harvestedAt) == ("sig-a1", P + "a/9-summary", "Summary", D1)
    assert paths(lab.to["a"]) == ["/docs/one", "/docs/two"] and set(lab.by) == {"a", "b"} and out.counts["fetched"] == 2


def test_unchanged_signatures_are_not_read_again(lab):
    lab.run()
    before, links = lab.by, lab.to
    lab.run(D2)
    assert lab.asked == [] and lab.by == before and lab.to == links and lab.full_at == D1


def test_a_changed_signature_replaces_its_record_alone(lab):
    lab.run()
    lab.modules["a"], lab.pages["a"] = "sig-a2", ["/docs/new"]
    lab.run(D2)
    assert [m for m, _ in lab.asked] == ["a"] and paths(lab.to["a"]) == ["/docs/new"]
    assert (lab.by["a"].unitSig, lab.by["a"].harvestedAt, lab.by["b"].harvestedAt) == ("sig-a2", D2, D1)


def test_a_failed_module_keeps_its_record_while_its_signature_stands(lab):
    lab.run()
    lab.pages["a"] = "failed"
    out = lab.run(D2, full=True)
    assert set(lab.by) == {"a", "b"} and lab.full_at == D1 and out.counts["failed"] == 1 and paths(lab.to["a"]) == ["/docs/one", "/docs/two"]
    lab.modules["a"] = "sig-a2"
    lab.run(D2)
    assert set(lab.by) == {"b"} and "a" not in lab.to


def test_the_clock_makes_a_full_pass_and_a_budget_leaves_it_open(lab):
    lab.run()
    lab.run(D3)
    assert [m for m, _ in lab.asked] == ["a", "b"] and lab.full_at == D3
    lab.full_at = D1
    out = lab.run(D3, limits=ML.LinkLimits(fetches=1))
    assert out.counts["waiting"] == 1 and lab.full_at == D1
    lab.scope, lab.modules["b"] = ["a", "b"], None
    out = lab.run(D3)
    assert {r.path.removeprefix(P): r.action for r in out.plan.collect()} == {"a": "fetch", "b": "no-units"} and "b" in lab.by


def test_links_are_kept_rewritten_dropped_and_dated(lab):
    lab.redirects = [("/docs/old", "/docs/new/place", "moved", "2026-01-01"), ("/docs/deep/x", "/docs/deep", "moved", "2026-01-01")]
    lab.pages["a"] = ["/docs/one", "/docs/old", "/docs/deep/x", "/docs/u1", "/docs/u2", "/docs/u3", "/docs/u4", "/docs/new/place", "https://o.example/", "https://o.example/"]
    lab.live = {"/docs/u2": ("moved", "/docs/u2-new/y"), "/docs/u3": ("broken", None), "/docs/u4": ("unknown", None)}
    out = lab.run()
    assert lab.checked == ["/docs/new/place", "/docs/u1", "/docs/u2", "/docs/u3", "/docs/u4"]
    got = {r.path or r.url: (r.was, r.checked, r.unverified) for r in lab.to["a"]}
    assert got == {
        "/docs/one": (None, None, False),
        "/docs/new/place": ("/docs/old", None, False),
        "/docs/u1": (None, D1, False),
        "/docs/u2-new/y": ("/docs/u2", D1, False),
        "/docs/u4": (None, None, True),
        "https://o.example/": (None, None, False),
    }
    assert (out.counts["probed"], out.counts["dropped"], out.counts["unknown"], out.counts["links_drop"]) == (5, 1, 1, 2)
    lab.live["/docs/u4"] = ("ok", None)
    lab.run(D2)
    assert "/docs/u1" not in lab.checked and "/docs/u4" in lab.checked
    again = {r.path: (r.was, r.checked) for r in lab.to["a"]}
    assert again["/docs/u1"] == (None, D1) and again["/docs/u4"] == (None, D2) and again["/docs/u2-new/y"] == ("/docs/u2", D1)


def test_checks_beyond_the_budget_wait_unverified(lab):
    lab.pages["a"] = ["/docs/u1", "/docs/u2"]
    lab.run(limits=ML.LinkLimits(probes=1))
    assert [(r.path, r.checked, r.unverified) for r in lab.to["a"]] == [("/docs/u1", D1, False), ("/docs/u2", None, True)]


@pytest.mark.parametrize(("bad", "word"), [("layout", "without unit content"), ("failed", "could not be read")])
def test_bad_pages_stop_the_run(lab, bad, word):
    lab.pages.update(a=bad, b=bad)
    with pytest.raises(GateFailure, match=word):
        lab.run(limits=ML.LinkLimits(least_sample=2))


def test_vanished_links_and_broken_checks_stop_the_run(lab):
    lab.run()
    lab.pages.update(a=[], b=[])
    with pytest.raises(GateFailure, match="modules with links"):
        lab.run(D2, full=True, limits=ML.LinkLimits(least_before=2))
    lab.pages.update(a=["/docs/u1", "/docs/u2", "/docs/u3"])
    lab.live = dict.fromkeys(lab.pages["a"], ("unknown", None))
    with pytest.raises(GateFailure, match="2 checks"):
        lab.run(D2, full=True, limits=ML.LinkLimits(breaker=2, probe_chunk=2))
    with pytest.raises(GateFailure, match="without a result"):
        lab.run(D2, full=True, limits=ML.LinkLimits(least_sample=2))
