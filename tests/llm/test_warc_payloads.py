import base64
import hashlib

from tidemark.llm import warc as W


def test_a_page_with_two_payloads_keeps_the_unique_one(spark):
    rows = [(1, "copy"), (1, "alone"), (2, "copy"), (3, "copy"), (3, "other"), (4, "other")]
    df = spark.createDataFrame([(p, f"http://x/{p}", h) for p, h in rows], "page_id long, url string, html string").coalesce(1)
    sha = lambda h: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
    last = {h: max(p for p, x in rows if x == h) for _, h in rows}
    want = sorted((p, sha(h), "response" if last[h] == p else "revisit", -1 if last[h] == p else last[h]) for p, h in rows)
    got = W.resolved_pages(df).collect()
    assert sorted((r.page_id, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to) for r in got) == want
