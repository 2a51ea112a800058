"""The apply step and the refresh fixpoint, against the cases they must hold."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.config import LedgerError
from tidemark.operators import ledger as L
from tidemark.operators import queues
from tidemark.operators.dedupe import same_rows

DAY = "2024-02-10"
M = "/training/modules/"
CANDIDATE = "path string, kind string, parent string, title string, evidence string, firstSeen string"
RESULT = "path string, outcome string, to string, status int"


def entry(path, kind="module", outcome="gone", to=None, seen="2024-01-01", verified="2024-01-20", evidence="tombstone", family="learn", title=None):
    return ("moved" if outcome == "moved" else "removed", path, kind, family, outcome, to, title, None, seen, None if outcome == "unverified" else verified, evidence, None)


def tables(spark, entries=(), candidates=(), results=(), live=()):
    return (
        spark.createDataFrame(list(entries), L.ENTRY),
        spark.createDataFrame([(*c, *(None,) * (6 - len(c))) for c in candidates], CANDIDATE),
        spark.createDataFrame([(*r, *(None,) * (4 - len(r))) for r in results], RESULT),
        spark.createDataFrame([(p,) for p in live], "path string"),
    )


def tombstone(name, seen="2024-02-01"):
    return (M + name, "module", None, None, "tombstone", seen)


class Site:
    """Answers of a site, and what it was asked."""

    def __init__(self, spark, answers=None, default=None, most=None):
        self.spark, self.answers, self.default, self.most, self.asked = spark, answers or {}, default, most, []

    def __call__(self, queue):
        rows = [r.path for r in queue.orderBy("queue_pos").collect()]
        rows = rows[: self.most] if self.most is not None else rows
        self.asked.append(rows)
        found = [(p, self.answers.get(p, self.default)) for p in rows]
        return self.spark.createDataFrame([(p, o, None, None) for p, o in found if o], RESULT)


def refreshed(spark, entries, candidates, probe, limit=50, live=(), **more):
    ledger, new, _, alive = tables(spark, entries, candidates, (), live)
    return L.refresh_detailed(ledger, new, alive, "learn", DAY, probe, limit, **more)


def outcomes(ledger):
    rows = [(r.path, r.outcome) for r in ledger.collect()]
    assert len(rows) == len(set(p for p, _ in rows))
    return dict(rows)


def test_units_come_back_with_their_module(spark):
    """A module recorded gone, its unit too; the probe finds the module live: the unit's entry stays."""
    start = [entry(M + "m"), entry(M + "m/u", "unit", evidence="unit-diff", seen="2023-12-01")]
    site = Site(spark, {M + "m": "live", M + "m/u": "gone"})
    out = refreshed(spark, start, [], site)
    assert outcomes(out.ledger) == {M + "m/u": "gone"}
    assert out.ledger.first().firstSeen == "2023-12-01"
    assert (out.resurrected, out.covered, out.stopped_early) == (1, 0, False)


def test_units_survive_a_flap_without_probes(spark):
    """The module is missing for one run and no probe may be spent; it is back in the next: its units' entries are as before."""
    units = [entry(M + "m/u1", "unit", evidence="unit-diff"), entry(M + "m/u2", "unit", "moved", M + "m/u3", evidence="unit-diff")]
    site = Site(spark, default="gone")
    during = refreshed(spark, units, [tombstone("m")], site, limit=0)
    assert outcomes(during.ledger) == {M + "m": "unverified", M + "m/u1": "gone", M + "m/u2": "moved"} and site.asked == []
    assert during.budget_exhausted and during.unverified == 1 and during.new_removed == 1
    ledger, none, _, live = tables(spark, live=[M + "m"])
    after = L.refresh_detailed(during.ledger, none, live, "learn", DAY, site, 0)
    assert same_rows(after.ledger, spark.createDataFrame(units, L.ENTRY))


def test_a_blocked_module_keeps_its_units_unprobed(spark):
    units = [entry(M + "m/u1", "unit", evidence="unit-diff"), entry(M + "m/u2", "unit", "unverified", evidence="unit-diff")]
    site = Site(spark, default="transient")
    out = refreshed(spark, units, [tombstone("m")], site)
    assert outcomes(out.ledger) == {M + "m": "unverified", M + "m/u1": "gone", M + "m/u2": "unverified"}
    assert site.asked == [[M + "m"]] and (out.probed, out.transient) == (1, 1)


def test_a_probed_entry_survives_no_answer_and_goes_when_the_cache_vouches(spark):
    kept = entry(M + "f10", outcome="landing", to="/training/paths/azure", seen="2023-10-26", evidence="hierarchy-not-found")
    again = [(M + "f10", "module", None, None, "hierarchy-not-found", "2024-02-10")]
    out = refreshed(spark, [kept], again, Site(spark, default="landing"))
    row = out.ledger.first()
    assert (row.outcome, row.firstSeen, row.evidence, row.lastVerified) == ("landing", "2023-10-26", "hierarchy-not-found", DAY)
    site = Site(spark, default="gone")
    gone = refreshed(spark, [kept], [], site, live=[M + "f10"])
    assert outcomes(gone.ledger) == {} and site.asked == [] and gone.resurrected == 1


def test_one_budget_for_the_run(spark):
    site = Site(spark, default="gone")
    out = refreshed(spark, [], [tombstone(f"m{i}", f"2024-01-0{i}") for i in range(1, 7)], site, limit=2)
    assert site.asked == [[M + "m1", M + "m2"]]
    assert (out.probed, out.budget_exhausted, out.unverified, out.new_removed) == (2, True, 4, 6)


def test_rounds_go_on_with_new_work_only(spark):
    """A moved module frees its units for the second round; known entries are verified again in the first alone."""
    start = [entry(M + f"k{i}", verified=f"2024-01-0{i}") for i in range(1, 5)]
    new = [tombstone("m"), (M + "m/u", "unit", M + "m", None, "unit-diff", "2024-02-01")]
    site = Site(spark, {M + "m": "moved"}, default="gone")
    out = refreshed(spark, start, new, site, reverify=2)
    assert site.asked == [[M + "m", M + "k1", M + "k2"], [M + "m/u"]]
    assert outcomes(out.ledger)[M + "m/u"] == "gone" and (out.new_moved, out.new_removed) == (1, 1)


def test_answered_rows_do_not_starve_the_others(spark):
    """Transient answers stay unverified at the head of the queue, yet the next round goes on behind them."""
    new = [tombstone("m"), (M + "m/u", "unit", M + "m", None, "unit-diff", "2024-02-01"), *(tombstone(f"t{i}", "2023-01-01") for i in range(3))]
    site = Site(spark, {M + "m": "moved", M + "m/u": "gone"}, default="transient")
    refreshed(spark, [], new, site, limit=5)
    assert site.asked == [[M + "t0", M + "t1", M + "t2", M + "m"], [M + "m/u"]]


def test_rows_without_an_answer_end_the_rounds(spark):
    site = Site(spark, default="transient", most=2)
    out = refreshed(spark, [], [tombstone(f"m{i}") for i in range(5)], site)
    assert len(site.asked) == 1 and out.stopped_early and out.probed == 2 and out.unverified == 5
    site = Site(spark, {M + "m0": "gone", M + "m1": "transient", M + "m2": "transient", M + "m3": "gone"}, default="gone")
    out = refreshed(spark, [], [tombstone(f"m{i}") for i in range(5)], site, streak=2)
    assert outcomes(out.ledger) == {M + "m0": "gone", **{M + f"m{i}": "unverified" for i in range(1, 5)}} and out.stopped_early and out.transient == 2


def test_a_destination_known_dead_is_asked_again(spark):
    start = [entry(M + "a", outcome="moved", to=M + "b", verified=DAY), entry(M + "c", outcome="moved", to=M + "d", verified=DAY)]
    site = Site(spark, {M + "a": "gone"})
    refreshed(spark, start, [], site, dead=spark.createDataFrame([(M + "b",)], "path string"))
    assert site.asked == [[M + "a"]]


def test_one_entry_a_path_whatever_the_candidates(spark):
    """A rename and a tombstone of one module, spellings of one path, bad rows: the strongest is taken, the others are none."""
    _, none, nothing, live = tables(spark)
    new = [
        (M + "a", "module", None, "Renamed", "rename", "2024-01-03"),
        ("https://site.example/en-us" + M + "A/", "module", "/training/paths/P/", " Tombstone ", "tombstone", "2024-01-05"),
        (M + "b", "module", None, None, "rumour", "2024-01-01"),
        (M + "c", "module", None, None, "tombstone", "nonsense"),
        (M + "d", "planet", None, None, "tombstone", "2024-01-01"),
        ("relative", "module", None, None, "tombstone", "2024-01-01"),
        ("/", "module", None, None, "tombstone", "2024-01-01"),
        (None, "module", None, None, "tombstone", "2024-01-01"),
        ("/docs/x", "docs", None, None, "quarantine", "2024-01-01"),
    ]
    start, found, _, _ = tables(spark, [], new)
    got = {r.path: r for r in L.apply_changes(start, found, nothing, live, "learn", DAY).collect()}
    assert set(got) == {M + "a", M + "c"}
    a = got[M + "a"]
    assert (a.evidence, a.title, a.parent, a.firstSeen, a.outcome, a.file) == ("tombstone", " Tombstone ", "/training/paths/p", "2024-01-05", "unverified", "removed")
    assert got[M + "c"].firstSeen == DAY


def test_of_equal_candidates_the_first_and_of_results_the_last(spark):
    start, _, _, live = tables(spark)
    new = spark.createDataFrame([(M + "a", "module", None, t, "rename", None, o) for t, o in (("B", 2), ("C", 1), ("A", 3))], CANDIDATE + ", ordinal int")
    told = [(M + "a", "gone", None, 404, 1), ("/en-us" + M + "A", "moved", M + "z", 301, 3), (M + "a", "transient", None, None, 2)]
    for shuffled in (told, told[::-1]):
        results = spark.createDataFrame(shuffled, RESULT + ", ordinal int")
        row = L.apply_changes(start, new, results, live, "learn", DAY).collect()
        assert [(r.title, r.outcome, r.to, r.status, r.file) for r in row] == [("C", "moved", M + "z", 301, "moved")]
    last = spark.createDataFrame([*told, (M + "a", "live", None, 200, 4)], RESULT + ", ordinal int")
    step = L.apply_detailed(spark.createDataFrame([entry(M + "a")], L.ENTRY), new, last, live, "learn", DAY)
    assert step.ledger.isEmpty() and [r.path for r in step.resurrected.collect()] == [M + "a"]


def test_entries_of_one_path_in_both_files_become_one(spark):
    start = [entry(M + "a", verified="2024-01-05", seen="2023-05-01"), entry(M + "a", outcome="moved", to="/x", verified="2024-01-09"), entry("/docs/d", "docs", family="docs", evidence="quarantine"), ("removed", M + "bad", "module", "learn", "nowhere", None, None, None, "2024-01-01", None, "tombstone", None)]
    ledger, none, nothing, live = tables(spark, start)
    got = {r.path: r for r in L.apply_changes(ledger, none, nothing, live, "learn", DAY).collect()}
    assert set(got) == {M + "a", "/docs/d"} and (got[M + "a"].outcome, got[M + "a"].firstSeen) == ("moved", "2023-05-01")


def test_covered_and_resurrected_are_told(spark):
    start = [entry(M + "m", outcome="unverified"), entry(M + "m/u", "unit", evidence="unit-diff"), entry(M + "n")]
    ledger, none, told, live = tables(spark, start, [], [(M + "m", "retired", "/archive/m", 301)], [M + "n"])
    step = L.apply_detailed(ledger, none, told, live, "learn", DAY)
    assert [r.path for r in step.covered.collect()] == [M + "m/u"] and [r.path for r in step.resurrected.collect()] == [M + "n"]
    assert outcomes(step.ledger) == {M + "m": "retired"}
    with pytest.raises(LedgerError):
        L.refresh_detailed(ledger, none, live, "learn", "soon", None, 1)


@pytest.mark.parametrize("seed", range(4))
def test_breaker_against_a_loop(spark, monkeypatch, seed):
    monkeypatch.setattr(queues, "BLOCK", 7)
    rng = random.Random(seed)
    rows = [(i, rng.random() < 0.7, rng.random() < 0.01) for i in range(3, 200) if rng.random() < 0.9]
    df = spark.createDataFrame(rows, "n int, bad boolean, late boolean")
    for streak in (0, 1, 4, 9, 40):
        want, run = [], 0
        for n, bad, late in rows:
            if late:
                break
            want.append(n)
            run = run + 1 if bad else 0
            if streak and run >= streak:
                break
        got = queues.before_trip(df, "n", F.col("bad"), streak, F.col("late"))
        assert sorted(r.n for r in got.collect()) == want
    assert queues.before_trip(df, "n", F.col("bad"), 0).count() == len(rows)
    assert queues.before_trip(df.where("n < 0"), "n", F.col("bad"), 3).count() == 0
