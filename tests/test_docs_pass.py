"""The documentation run as a whole: phases, clocks, breakers, other sources, gates."""

import pytest
from pyspark.sql import functions as F

from tidemark.config import GateFailure, Limits, Scope, Site
from tidemark.operators import ledger as L
from tidemark.plans.docs_pass import ANSWER, docs_pass, phase_queue, run_phases

SITE = Site(host="h", learn=Scope(("/docs",), ("/docs/internal",)), index=Scope(("/ref",)))
TODAY = "2024-03-01"
RECORD = "path string, url string, title string, lastmod string, checked string, stamped boolean, source string"
HELD = "path string, url string, title string, status int, firstDetected string, lastChecked string"
REDIRECT = "from string, to string, kind string, status int, firstSeen string, lastSeen string"


class Web:
    """Answers by key, one a second apart unless told otherwise."""

    def __init__(self, spark, answers=None, default="live", seconds=1.0):
        self.spark, self.answers, self.default, self.seconds, self.clock, self.asked = spark, answers or {}, default, seconds, 0.0, []

    def __call__(self, queue):
        out = []
        for r in queue.orderBy("queue_pos").collect():
            outcome = self.answers.get(r.key, self.default)
            self.asked.append((r.phase, r.key))
            out.append((r.phase, r.key, outcome, {"gone": 404, "live": 200}.get(outcome), "/docs/to/x" if outcome == "moved" else None, "New" if outcome == "live" else None, False, self.clock))
            self.clock += self.seconds
        return self.spark.createDataFrame(out, ANSWER)


def run(spark, web, pages=10, changed=0, catalogue=None, quarantine=(), index=None, limits=None, git=None, git_failed=None, foreign=(), least=1, **more):
    make = spark.createDataFrame
    rows = [(f"/docs/p{i:02}", f"https://h/docs/p{i:02}", "2024-02-20" if i < changed else "2024-02-01") for i in range(pages)]
    if catalogue is None:
        catalogue = [(p, u, "Old", "2024-02-01", f"2024-01-{i + 1:02}", True, None) for i, (p, u, _) in enumerate(rows)]
    index = [(r[0], r[2]) for r in rows] if index is None else index
    return docs_pass(
        make(rows, "path string, url string, lastmod string"), make([*catalogue, *foreign], RECORD), make(index, "path string, lastmod string"), make(list(quarantine), HELD), make([], REDIRECT), make([], L.ENTRY),
        web, TODAY, SITE, limits or Limits(verify=0), git=git, git_failed=git_failed, least_records=least, **more,
    )


def titles(out):
    return {r.url: r.title for r in out.records.collect()}


def test_the_clock_stops_a_phase_and_the_rest_waits(spark):
    web = Web(spark, seconds=60)
    out = run(spark, web, changed=8, limits=Limits(runtime_minutes=5, verify=3))
    assert out.phases.stops == {"fetch": "deadline", "verify": "deadline"} and out.phases.requests == {"fetch": 5, "verify": 0}
    assert list(titles(out).values()).count("New") == 5 and len(titles(out)) == 10
    assert out.counts["deferredChanged"] == 3 and not out.complete and out.failures == []
    out = run(spark, Web(spark), changed=8)
    assert out.phases.stops == {} and out.counts["deferredChanged"] == 0 and out.complete


def test_a_storm_trips_the_breaker_of_its_phase_alone(spark):
    web = Web(spark, {f"/docs/p{i:02}": "transient" for i in range(8)}, seconds=0)
    out = run(spark, web, changed=8, limits=Limits(transient_streak=3, verify=2))
    assert out.phases.stops == {"fetch": "breaker"} and out.phases.requests == {"fetch": 3, "verify": 2} and out.phases.degraded
    assert len(titles(out)) == 10 and out.counts["deferredChanged"] == 8 and out.counts["quarantined"] == 0 and not out.complete
    assert out.failures == ["the fetch phase hit the breaker"]
    out = run(spark, web, changed=3, limits=Limits(transient_streak=3, verify=0))
    assert out.phases.stops == {}, "nothing was left when the streak was full"


def test_pages_of_other_sites(spark):
    foreign = [(None, "https://git/a", "A", None, None, None, "one"), (None, "https://git/b", "B", None, None, None, "two")]
    out = run(spark, Web(spark), foreign=foreign)
    assert {u for u in titles(out) if "git" in u} == {"https://git/a", "https://git/b"}
    fresh = spark.createDataFrame([("https://git/a2", "A2", "one")], "url string, title string, source string")
    out = run(spark, Web(spark), foreign=foreign, git=fresh)
    assert {u: t for u, t in titles(out).items() if "git" in u} == {"https://git/a2": "A2"}
    failed = spark.createDataFrame([("two",)], "source string")
    out = run(spark, Web(spark), foreign=foreign, git=fresh, git_failed=failed)
    assert {u for u in titles(out) if "git" in u} == {"https://git/a2", "https://git/b"} and out.failures == ["a source failed, its previous records were carried forward"]


def test_quarantined_pages_of_other_sites(spark):
    quarantine = [(None, f"https://git/{x}", x, 404, "2024-01-01", f"2024-01-0{i}") for i, x in enumerate("abcd", 2)] + [(None, "https://git/a", "a", 410, "2023-12-01", "2024-01-01"), ("/docs/p00", "https://h/docs/p00", "Q", 404, "2024-01-01", "2024-01-09")]
    web = Web(spark, {"https://git/a": "live", "https://git/b": "gone", "https://git/c": "transient", "/docs/p00": "gone"})
    out = run(spark, web, quarantine=quarantine, limits=Limits(verify=0, quarantine_rechecks=3))
    assert web.asked == [("quarantine", f"https://git/{x}") for x in "abc"]
    assert titles(out)["https://git/a"] == "a" and out.counts["externalReleased"] == 1
    left = {r.url: (r.path, r.status, r.firstDetected, r.lastChecked) for r in out.quarantine.collect()}
    assert left == {"https://git/b": (None, 404, "2024-01-01", TODAY), "https://git/c": (None, 404, "2024-01-01", "2024-01-04"), "https://git/d": (None, 404, "2024-01-01", "2024-01-05"), "https://h/docs/p00": ("/docs/p00", 404, "2024-01-01", "2024-01-09")}
    assert out.counts["quarantined"] == 4 and {r.path for r in out.ledger.collect()} == {"/docs/p00"}


def test_mass_quarantine_and_doubles_stop_the_run(spark):
    storm = Web(spark, default="gone")
    with pytest.raises(GateFailure, match="catalogue records"):
        run(spark, storm, changed=8)
    out = run(spark, storm, changed=3)
    assert len(titles(out)) == 7 and out.counts["quarantined"] == 3
    with pytest.raises(GateFailure, match="index-size"):
        run(spark, storm, pages=5, index=[(f"/docs/p{i:02}", None) for i in range(10)])
    twice = [(None, f"https://git/x{i % 60}", "t", None, None, None, "one") for i in range(120)]
    with pytest.raises(GateFailure, match="duplicated"):
        run(spark, Web(spark), foreign=twice)
    out = run(spark, Web(spark), foreign=twice[:1] * 2 + [(None, "https://git/X0", "t", None, None, None, "one"), (None, "https://git/docs/p00", "other site", None, None, None, "one")])
    assert titles(out)["https://git/docs/p00"] == "other site"
    assert out.counts["duplicatesDropped"] == 2 and len([u for u in titles(out) if "git/" in u and "docs" not in u]) == 1


def test_queues_have_their_orders(spark):
    index = [(f"/docs/p{i:02}", None) for i in range(10)] + [("/docs/m1", None), ("/docs/m2", None)]
    catalogue = [(f"/docs/p{i:02}", f"https://h/docs/p{i:02}", "Old", "2024-02-01", f"2024-01-{20 - i:02}", True, None) for i in range(8)] + [("/docs/m1", "https://h/docs/m1", "M", "2024-01-01", "2024-01-01", True, None)]
    web = Web(spark, {"/docs/m1": "moved", "/docs/m2": "transient"})
    out = run(spark, web, pages=11, changed=2, catalogue=catalogue, index=index, limits=Limits(verify=2))
    assert web.asked == [("missing", "/docs/m1"), ("missing", "/docs/m2"), ("fetch", "/docs/p00"), ("fetch", "/docs/p01"), ("fetch", "/docs/p08"), ("fetch", "/docs/p09"), ("fetch", "/docs/p10"), ("verify", "/docs/p07"), ("verify", "/docs/p06")]
    assert {r["from"]: r.to for r in out.redirects.collect()} == {"/docs/m1": "/docs/to/x"} and "/docs/m2" in {r.path for r in out.index.collect()}
    assert out.counts["deferredMissing"] == 1


def test_no_queue_no_phase(spark):
    empty = spark.createDataFrame([], "phase string, key string, path string, url string, external boolean, queue_pos long")
    got = run_phases(empty, lambda q: 1 / 0)
    assert got.answers.isEmpty() and got.stops == {} and not got.degraded
    out = run(spark, Web(spark), pages=0, index=[], catalogue=[], least=0)
    assert out.records.isEmpty() and out.complete
    assert phase_queue(out.states.withColumns({c: F.lit(None).cast("string") for c in ("prev_checked", "q_lastChecked")} | {"has_record": F.lit(False)}), spark.createDataFrame([], "url string, lastChecked string")).isEmpty()
