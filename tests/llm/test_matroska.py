import hashlib
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import matroska as M
from tidemark.llm.queries import queries


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 400_000), st.integers(0, 255))
def test_round_trip(n, seed):
    data = bytes((i * 31 + seed) % 256 for i in range(n % 7000)) * (1 + n // 40_000)
    payload = M.padded(data)
    assert payload.startswith(data) and len(payload) % 576 == 0 and payload and set(payload[len(data) :]) <= {255}
    file = M.write(payload)
    m = M.parse(file)
    assert m.doctype == "matroska" and b"".join(file[p.start : p.end] for p in m.packets) == payload
    assert [p.time for p in m.packets] == [72 * i for i in range(len(m.packets))] and m.duration == 72 * len(m.packets)
    assert {c.cluster for c in m.cues} == {p.cluster for p in m.packets}
    assert all(file[c.cluster : c.cluster + 4] == bytes.fromhex("1f43b675") for c in m.cues)


@pytest.mark.parametrize("n", [0, 1, 126, 127, 128, 16382, 16383, 2**21 - 2, 2**21 - 1, 2**40])
def test_sizes(n):
    data = M.size_bytes(n)
    assert M.read_vint(data, 0) == (n, len(data))


def ebml_lace(sizes):
    out = M.size_bytes(sizes[0])
    for a, b in zip(sizes, sizes[1:-1]):
        d = b - a
        width = 1
        while not -((1 << (7 * width - 1)) - 1) <= d <= (1 << (7 * width - 1)) - 1:
            width += 1
        out += ((1 << (7 * width)) | (d + (1 << (7 * width - 1)) - 1)).to_bytes(width, "big")
    return out


@pytest.mark.parametrize("sizes", [[3, 2, 5], [600, 10, 255, 0], [255, 510, 1], [1, 40000, 2, 7]])
def test_lacing_and_unknown_sizes(sizes):
    frames = [bytes([i + 1]) * n for i, n in enumerate(sizes)]
    xiph = b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    body = b"".join(frames)
    blocks = [b"\x81" + struct.pack(">hB", -2, 0x80 | 2) + bytes([len(sizes) - 1]) + xiph + body, b"\x82" + struct.pack(">hB", 5, 6) + bytes([len(sizes) - 1]) + ebml_lace(sizes) + body]
    group = M.element(M.GROUP, M.element(M.BLOCK, b"\x81" + struct.pack(">hB", 9, 0) + b"alone") + M.number(M.LENGTH, 3))
    cluster = lambda t, x: M.id_bytes(M.CLUSTER) + b"\x01" + b"\xff" * 7 + M.number(M.TIME, t) + x
    file = M.element(M.EBML, M.element(M.DOCTYPE, b"webm")) + M.id_bytes(M.SEGMENT) + b"\xff" + M.element(M.VOID, b"12") + cluster(100, M.element(M.SIMPLE_BLOCK, blocks[0])) + cluster(200, M.element(M.SIMPLE_BLOCK, blocks[1]) + group)
    m = M.parse(file)
    assert m.doctype == "webm"
    assert [file[p.start : p.end] for p in m.packets] == frames + frames + [b"alone"]
    assert [p.time for p in m.packets] == [98] * len(sizes) + [205] * len(sizes) + [209]
    assert [p.track for p in m.packets] == [1] * len(sizes) + [2] * len(sizes) + [1]
    assert len({p.cluster for p in m.packets}) == 2


def test_damage_is_an_error():
    file = M.write(M.padded(b"x" * 2000))
    for cut in (0, 3, 20, 60, 300, len(file) - 1):
        with pytest.raises(ValueError):
            M.parse(file[:cut])
    with pytest.raises(ValueError):
        M.parse(b"RIFF" + file)


def test_tables(spark):
    rows = [(None, "a"), (1, None), (2, ""), (3, "é" * 100_000), (4, "x" * 576), (4, "x" * 576), (5, "x" * 577)]
    df = spark.createDataFrame([(a, b, b"m") for a, b in rows], "doc_id long, text string, media binary")
    got = M.features(M.stored(df)).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3, 4, 4, 5]
    by = {r.doc_id: r for r in got}
    assert by[1][1:] == by[2][1:] and by[1].payload_bytes == 576 and by[4].payload_bytes == 576 and by[5].payload_bytes == 1152
    packets = M.packet_table(M.stored(df).withColumnRenamed("doc_id", "media_id"))
    assert packets.where("media_id = 3").count() == by[3].packets == -(-200_000 // 576) and packets.where("not cued").count() == 0
    assert M.features(M.stored(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
    nulls = M.with_packets(spark.createDataFrame([(1, None), (2, M.write(M.padded(b"ab")))], "media_id long, clip binary"), "clip")
    assert {r.media_id: (r.packets and [(p.byte_end - p.byte_start, p.cued) for p in r.packets], r.cues) for r in nulls.collect()} == {1: (None, None), 2: ([(576, True)], 1)}


def test_query_on_table(spark):
    path = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = queries()["op6_media_columns"](spark, path).collect()
    assert len(got) == len(docs)
    for r in got:
        payload = M.padded(docs[r.doc_id])
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(docs[r.doc_id]), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r.media_sha256 == hashlib.sha256(M.write(payload)).hexdigest() and r.media_bytes == len(M.write(payload))
