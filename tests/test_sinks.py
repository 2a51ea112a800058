"""Files and tables that are put in place in one step, and texts in the order of their table."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import utf16_key
from tidemark.operators import ledger as L
from tidemark.operators import records
from tidemark.sources import files


def test_many_partitions_keep_their_order(spark, tmp_path):
    path = str(tmp_path / "x.txt")
    rows = spark.range(5000).select(F.col("id"), F.format_string("%05d", "id").alias("value"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_text(rows.repartition(7).orderBy(F.desc("id")).select("value"), path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert open(path).read().split() == [f"{i:05}" for i in reversed(range(5000))]
    files.write_text(rows.where("id < 0").select("value"), path)
    assert open(path).read() == "" and sorted(n for n in os.listdir(tmp_path) if not n.startswith(".")) == ["x.txt"]


def test_a_failed_write_leaves_the_old_file(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "x.txt")
    lines = lambda *t: spark.createDataFrame([(x,) for x in t], "value string")
    files.write_text(lines("old"), path)
    with pytest.raises(Exception, match="stop"):
        files.write_text(lines("new").select(F.when(F.length("value") > 0, F.raise_error(F.lit("stop"))).cast("string").alias("value")), path)
    assert open(path).read() == "old\n"
    seen = []
    real = files.put_in_place
    monkeypatch.setattr(files, "put_in_place", lambda *a: seen.append(open(path).read()) or real(*a))
    files.write_text(lines("new"), path)
    assert seen == ["old\n"] and open(path).read() == "new\n"
    assert [n for n in os.listdir(tmp_path) if n.endswith(".tmp")] == []


def test_a_table_is_set_aside_and_restored(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.write_if_changed(spark.range(3), path)
    os.rename(path, path + ".before")  # killed between both renames
    assert not files.write_if_changed(spark.range(3), path) and os.path.isdir(path)
    spark.range(2).write.parquet(path + ".before")  # killed before the old one was removed
    assert files.write_if_changed(spark.range(4), path) and spark.read.parquet(path).count() == 4
    assert sorted(n for n in os.listdir(tmp_path) if not n.startswith(".")) == ["t"]


def test_large_documents_are_sorted_streams(spark, tmp_path):
    path = str(tmp_path / "e.json")
    rows = spark.range(3000).select(F.format_string("/p%04d", F.col("id") % 1500).alias("path"), (F.col("id") % 3).alias("b"), F.lit(None).cast("string").alias("a")).repartition(9)
    made = records.envelope(rows, "path", "now", scope="é")
    assert "collect_list" not in made._jdf.queryExecution().optimizedPlan().toString()
    files.write_text(made, path)
    got = json.load(open(path, encoding="utf-8"))
    assert (got["generatedAt"], got["scope"], got["count"], len(got["entries"])) == ("now", "é", 3000, 3000)
    assert [e["path"] for e in got["entries"]] == sorted(e["path"] for e in got["entries"]) and list(got["entries"][0]) == ["path", "a", "b"]
    empty = records.envelope(rows.where("b > 5"), "path", "now")
    assert json.loads("".join(r.value for r in empty.collect()))["entries"] == []


def test_a_ledger_file_begins_with_its_head(spark, tmp_path):
    rows = spark.range(400).select(F.lit("removed").alias("file"), F.format_string("/p%04d", "id").alias("path"), *[F.lit(v).cast(t).alias(n) for n, t, v in (("kind", "string", "docs"), ("family", "string", "docs"), ("outcome", "string", "gone"), ("to", "string", None), ("title", "string", None), ("parent", "string", None), ("firstSeen", "string", "2024-01-01"), ("lastVerified", "string", None), ("evidence", "string", "quarantine"), ("status", "int", 404))])
    files.write_ledger(rows.repartition(11), str(tmp_path), "2024-01-01T00:00:00Z")
    got = json.load(open(tmp_path / "removed.json"))
    assert [e["path"] for e in got["entries"]] == [f"/p{i:04}" for i in range(400)] and json.load(open(tmp_path / "moved.json"))["entries"] == []
    assert files.read_ledger(spark, str(tmp_path)).select(L.COLUMNS).count() == 400


def test_utf16_order(spark):
    words = ["z", "\U0001f600", "～", "é", "", "a\U00010000", "a"]
    got = [r.w for r in spark.createDataFrame([(w,) for w in words], "w string").orderBy(utf16_key("w")).collect()]
    assert got == sorted(words, key=lambda w: w.encode("utf-16-be")) != sorted(words)
