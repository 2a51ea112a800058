from pyspark.sql import functions as F

from tidemark.llm import imatch


def test_long_texts_with_other_terms_differ(spark):
    same = " ".join(f"s{i}" for i in range(2000))
    rows = [(i, f"{same} x{i}") for i in range(8)] + [(100 + i, f"x{i % 8} x{(i + 1) % 8}") for i in range(24)] + [(200 + i, f"y{i}") for i in range(40)] + [(300, f"x0 {same}")]
    got = imatch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id < 8 or doc_id = 300")
    pairs = got.alias("a").crossJoin(got.alias("b")).where("a.doc_id < b.doc_id")
    near = imatch.likeness("a.fingerprint", "b.fingerprint", "a.fingerprint_whole", "b.fingerprint_whole")
    pairs = pairs.select("a.doc_id", F.col("b.doc_id").alias("other"), near.alias("near"), F.expr("a.fingerprint = b.fingerprint").alias("sampled")).collect()
    assert any(r.sampled for r in pairs if r.other != 300)
    assert all((r.near == 1) == (r.doc_id == 0 and r.other == 300) for r in pairs)
