import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import suffix_dedup as S
from tidemark.llm.queries import queries


def brute(rows, length=100):
    seen, out = set(), {}
    for d, t in sorted(((d, t) for d, t in rows if d is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in seen:
                gone[i : i + length] = True
            else:
                seen.add(s)
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum())
        out[d] = (len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone]))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=40), min_size=1, max_size=12), st.integers(1, 4), st.integers(1, 6))
def test_merged_transforms(strings, shards, half):
    length = 2 * half
    symbols = np.array([x for s in strings for x in [*s, 0]], np.uint16)
    owner = np.repeat(np.arange(len(strings)), [len(s) + 1 for s in strings])
    where, block = S.repeated_intervals(symbols, owner * shards // len(strings), length)
    got = {}
    for p, b in zip(where.tolist(), block.tolist()):
        got.setdefault(b, set()).add(p)
    want = {}
    for i in range(len(symbols)):
        s = symbols[i : i + length]
        if len(s) == length and (s > 0).all():
            want.setdefault(s.tobytes(), set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=60), min_size=1, max_size=5))
def test_suffix_order(strings):
    symbols = np.array([x for s in strings for x in [*s, 0]], np.uint16)
    order = S.suffix_order(symbols).tolist()
    text = symbols.tolist()
    assert order == sorted(range(len(text)), key=lambda i: (text[i : text.index(0, i) + 1], i))


def fixture():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(2, 8)))
    passage = " ".join(word() for _ in range(80))
    rows = [(0, None), (1, ""), (2, "short"), (3, "x" * 99), (4, "x" * 100), (5, "x" * 350), (6, "ab" * 200), (7, "é" * 120)]
    for d in range(10, 70):
        t = " ".join(word() for _ in range(r.choice([5, 30, 120])))
        for _ in range(r.randrange(3)):
            a = r.randrange(len(passage) - 60)
            cut = passage[a : a + r.randrange(60, 400)]
            i = r.randrange(len(t))
            t = t[:i] + cut + t[i:]
        rows.append((d, t))
    for d in range(100, 120):  # near copies
        t = list(rows[30 + d % 4][1])
        for _ in range(r.randrange(4)):
            t[r.randrange(len(t))] = "Z"
        rows.append((d, "".join(t)))
    return rows + [(200, rows[20][1]), (201, rows[20][1]), (-3, rows[21][1])]


@pytest.mark.parametrize("hot,shard,batch", [(S.HOT, S.SHARD, S.BATCH), (3, 500, 2000), (10**9, 300, 1)])
def test_against_brute_force(spark, monkeypatch, hot, shard, batch):
    monkeypatch.setattr(S, "HOT", hot)
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeated_strings(df).collect()}
    want = brute(rows)
    assert {k: v[:3] for k, v in got.items()} == {k: v[:3] for k, v in want.items()}
    assert got == want


def test_batches_and_shards_give_the_same(monkeypatch):
    """The merge alone, over many batch and shard sizes, in this process."""
    import pyarrow as pa

    class Value:
        def __init__(self, v):
            self.value = v

    rows = fixture()
    ids, texts = pa.array([d for d, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())
    batch = pa.record_batch([ids, texts, pa.array([0] * len(rows), pa.int32())], ["doc_id", "text", "tag"])
    full = np.full(1 << 10, 255, np.uint8)
    want = None
    for shard, size in ((1 << 17, 1 << 20), (400, 3000), (200, 1)):
        monkeypatch.setattr(S, "SHARD", shard)
        monkeypatch.setattr(S, "BATCH", size)
        dealt = pa.Table.from_batches(list(S._deal(Value(full), Value(np.zeros(1 << 10, np.uint8)), 100, 40)([batch])))
        dealt = dealt.sort_by([("key", "ascending")])
        late = set()
        for out in S._merge(100, 40)(dealt.to_batches(max_chunksize=7)):
            late |= {(d, s + i) for d, s, n in zip(*(out.column(c).to_pylist() for c in ("doc_id", "start", "n"))) for i in range(n)}
        want = want or late
        assert late == want
    seen, brute_late = set(), set()
    for d, t in sorted(((d, (t or "").encode()) for d, t in rows), key=lambda r: r[0]):
        for i in range(len(t) - 99):
            if t[i : i + 100] in seen:
                brute_late.add((d, i))
            seen.add(t[i : i + 100])
    assert want == brute_late


def test_edges_of_tables(spark):
    assert S.remove_repeated_strings(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    text = "0123456789" * 5 + "".join(chr(97 + i % 26) + str(i) for i in range(60))
    df = spark.createDataFrame([(None, text, 1), (2, text, 1), (3, text, 1)], "doc_id long, text string, start int")
    assert sorted((r.doc_id, r.n_removed) for r in S.remove_repeated_strings(df).collect()) == [(2, 0), (3, len(text))]


def test_query_on_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    want = {d: (n, g, s, hashlib.sha256(k).hexdigest()) for d, (n, g, s, k) in brute(rows).items()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries()["op5_suffix_array_dedup"](spark, path).collect()}
    assert got == want


def test_one_id_with_several_texts(spark):
    def words(seed, n=60):
        r = random.Random(seed)
        return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))

    a, b, c = words(1), words(2), words(3)
    rows = [(1, a), (2, a + " " + b), (2, "short"), (2, c), (2, c), (4, words(4)), (5, b[:150] + " " + c[:150])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in S.remove_repeated_strings(df).collect())
    assert got == sorted([(1, len(a), 0, 0), (2, len(a + " " + b), len(a), 1), (2, 5, 0, 0), (2, len(c), 0, 0), (2, len(c), 0, 0), (4, len(rows[5][1]), 0, 0), (5, 301, 300, 2)])


def test_hot_minimizers_in_any_number(spark, monkeypatch):
    rows = fixture()
    monkeypatch.setattr(S, "HOT", 1)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeated_strings(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute(rows)
