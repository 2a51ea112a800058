"""Queues with large limits are numbered by ranges, and units meet their modules without the prefixes that all have."""

from pyspark.sql import functions as F

from tidemark.operators import queues
from tidemark.operators.joins import paths_below


def test_a_large_limit_gathers_nothing(spark):
    rows = spark.createDataFrame([(1 + i % 2, f"/p{i:02d}") for i in range(40)], "tier int, path string")
    out = queues.tiered(rows, "tier", [F.asc("path")], 100_000_000, {2: 3})
    assert "TakeOrderedAndProject" not in out._jdf.queryExecution().executedPlan().toString()
    got = [r.path for r in out.orderBy("queue_pos").collect()]
    assert got == [f"/p{i:02d}" for i in range(0, 40, 2)] + ["/p01", "/p03", "/p05"]
    assert [r.queue_pos for r in out.orderBy("queue_pos").collect()] == list(range(1, 24))


def test_large_and_small_limits_agree(spark, monkeypatch):
    rows = spark.createDataFrame([(1 + i % 3, f"/p{i:02d}") for i in range(40)], "tier int, path string")
    made = lambda: sorted(map(tuple, queues.tiered(rows, "tier", [F.desc("path")], 20, {3: 6}).collect()))
    small = made()
    monkeypatch.setattr(queues, "GATHERED", 5)
    assert made() == small and len(small) == 20


def test_paths_below(spark):
    t = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    got = paths_below(t("/a/b/c", "/a/b", "/a/bc/d", "/a", "/x/y", "/a/b/c/d", "/a/b/c", None), t("/a/b", "/a/b", "/a/b/c"))
    assert sorted(r.path for r in got.collect()) == ["/a/b/c", "/a/b/c/d"]
    assert paths_below(t("/a/b"), t("/a").limit(0)).count() == 0
