"""Joins and windows of large tables are dealt to more tasks than the session has by default, with the same results."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.plans import validate
from tidemark.plans.catalogue import QUERIES
from tidemark.sources import shared

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["validate_modules", "validate_units", "cleaned_links", "module_links_cleaned"])
def test_many_rows_take_more_tasks(spark, monkeypatch, name):
    rows = lambda: sorted((tuple(map(str, r)) for r in QUERIES[name](spark, SF).collect()))
    want = rows()
    monkeypatch.setattr(shared, "ROWS_A_TASK", 200)
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    dealt = [int(n) for n in re.findall(r"hashpartitioning\([^\n]*?, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert dealt and min(dealt) > 4
    assert rows() == want


def test_links_below_a_common_parent_keep_apart(spark):
    paths = spark.range(200).select(F.concat(F.lit("/training/modules/m"), "id").alias("path"))
    c = validate.Caches(modules=paths.select("path", F.array(F.concat("path", F.lit("/1-a"))).alias("unitUrls"), F.lit(False).alias("hierarchyNotFound")))
    out = validate.validate(paths.unionByName(paths.select(F.concat("path", F.lit("/1-a")).alias("path"))), c, url="path")
    assert {(r.kind, r.verdict): r.n for r in out.groupBy("kind", "verdict").agg(F.count("*").alias("n")).collect()} == {("module", "valid"): 200, ("unit", "valid"): 200}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter, \(_at#", plan)
