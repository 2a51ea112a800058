from tidemark.llm import warc as W
from tidemark.llm.session import written


def test_contents_are_not_exchanged(spark):
    rows = [(i, f"http://x/{i}", "same" if i < 5 else f"page {i}") for i in range(40)]
    raw, _ = W.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    plans = written(spark.createDataFrame([("f", [(1, "d", 2, "u")])], "file string, plans array<struct<page_id: long, payload_digest: string, original: long, original_url: string>>"), "plans")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = W._planned(spark, f"{raw}/class=0", plans).mapInArrow(W._rewrite("clean", "2001-02-03T04:05:06Z"), "record binary")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plan and "content" not in plan
        assert df.count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_parts_open_under_any_name(spark, tmp_path):
    for name in ("a b", "e=f", "c%d"):
        path = tmp_path / name
        path.mkdir()
        (path / "part-0").write_bytes(b"x" + name.encode())
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).select("path").collect()
    assert sorted(W._content(r.path) for r in found) == sorted(b"x" + n for n in (b"a b", b"e=f", b"c%d"))
