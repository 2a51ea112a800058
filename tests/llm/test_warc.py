import base64
import gzip
import hashlib

import pytest

from tidemark.llm import warc as W
from tidemark.llm.queries import queries


def brute(rows):
    seen = {}
    pages = {p: (h or "").encode() for p, h in rows if p is not None}
    for p, b in pages.items():
        seen.setdefault(b, []).append(p)
    out = {}
    for p, b in pages.items():
        first = max(seen[b])
        out[p] = (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if p == first else "revisit", None if p == first else first)
    return out


def got(df):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()}


def test_small_tables(spark, monkeypatch):
    monkeypatch.setattr(W, "PART_BYTES", 7 * W.LEAST_CLASS)
    rows = [(None, "x"), (1, None), (2, ""), (3, "a\r\n\r\nWARC/1.1\r\nb"), (4, "a\r\n\r\nWARC/1.1\r\nb"), (5, "é" * 200_000), (-6, "é" * 200_000)] + [(100 + i, "hot" if i % 3 == 0 else f"<p>{i % 20}\n</p>") for i in range(90)]
    df = spark.createDataFrame([(p, None if p == 3 else f"http://h/ a\n{p}", h, "f") for p, h in rows], "page_id long, url string, html string, file string").repartition(3)
    assert got(W.resolved_pages(df)) == brute(rows)
    limit = {r.page_id: r.record_type for r in W.resolved_pages(df, least_bytes=10).collect()}
    assert limit[100] == limit[103] == limit[1] == limit[2] == "response" and limit[3] == "revisit"
    assert W.resolved_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def parts(spark, path):
    return [(f.path, bytes(f.content)) for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path).collect()]


def test_archives_are_whole(spark):
    rows = [(i, f"http://x/{i}", "same" if i < 5 else f"page {i}\r\n\r\n") for i in range(12)]
    raw, clean = W.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), date="2001-02-03T04:05:06Z")
    ids = {}
    for path, responses in ((raw, 12), (clean, 8)):
        found = []
        for _, data in parts(spark, path):
            found += [(r.headers, content[r.start : r.end]) for _, _, r, content in W.packed_records(data)]
            whole = gzip.decompress(data)
            assert len(list(W.records(whole))) == len(list(W.members(data)))
        assert sorted(int(h["x-page-id"]) for h, _ in found) == list(range(12))
        assert sum(h["warc-type"] == "response" for h, _ in found) == responses
        ids[path] = {h["warc-record-id"]: h for h, _ in found}
        assert len(ids[path]) == 12
        for h, body in found:
            page = int(h["x-page-id"])
            assert h["warc-target-uri"] == f"http://x/{page}" and h["warc-date"] == "2001-02-03T04:05:06Z"
            if h["warc-type"] == "response":
                assert body.decode() == rows[page][2] and h["warc-payload-digest"] == "sha1:" + W.digest(body)
            else:
                assert not body and h["warc-refers-to-target-uri"] == "http://x/4" and h["warc-profile"] == W.PROFILE
                assert ids[path].get(h["warc-refers-to"], {}).get("x-page-id", "4") == "4"
    assert all(h["warc-refers-to"] in ids[clean] for h in ids[clean].values() if h["warc-type"] == "revisit")
    assert not set(ids[raw]) & set(ids[clean])


def test_parts_are_bounded_by_bytes_and_ranges_name_members(spark, monkeypatch):
    monkeypatch.setattr(W, "PART_BYTES", 64 << 10)
    monkeypatch.setattr(W, "LEAST_CLASS", 4 << 10)
    rows = [(i, f"http://x/{i}", chr(97 + i % 26) * (100 + 997 * i % 30_000)) for i in range(200)] + [(999, "http://x/big", "z" * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    found = W.resolved_pages(df).collect()
    html = {p: h for p, _, h in rows}
    size = {}
    for r in found:
        size.setdefault(r.file, []).append(r.payload_bytes)
    assert all(sum(x) <= 64 << 10 or len(x) == 1 for x in size.values()) and len(size) < 120
    files = {}
    for r in found:
        name = r.file.removeprefix("file:")
        data = files.setdefault(name, open(name, "rb").read())
        record = gzip.decompress(data[r.member_start : r.member_end])
        (one,) = W.records(record)
        assert one.headers["x-page-id"] == str(r.page_id)
        if r.record_type == "response":
            assert record[one.start : one.end].decode() == html[r.page_id]


def test_damage_is_an_error():
    good = W.response(1, "u", b"abc", W.digest(b"abc"), "a", "d") + b"\r\n\r\n"
    assert len(list(W.records(good * 2))) == 2
    for bad in (good[:-1], good[5:], b"x" + good, good[: len(good) // 2]):
        with pytest.raises(ValueError):
            list(W.records(bad))
    packed = W.member(good[:-4]) * 2
    assert len(list(W.members(packed))) == 2 and packed[-1] == 0
    for bad in (packed[:-1], packed[:-9], b"x" + packed, packed[: len(packed) // 3]):
        with pytest.raises(ValueError):
            list(W.members(bad))


def test_large_records_end_with_a_zero(monkeypatch):
    big = W.member(b"WARC" * (5 << 20))
    assert big[-1] == 0 and [len(c) for _, _, c in W.members(big)] == [(20 << 20) + 4]


def test_query_on_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{path}/pages.parquet").collect()]
    assert got(queries()["op8_warc_revisits"](spark, path)) == brute(rows)
