import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import simhash
from tidemark.llm.queries import queries

SF = "/root/testdata/sf0.001"


def slow(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    s = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(rows, budget=4):
    """Components by comparing all different fingerprints."""
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= budget:
                up[root(b)] = root(a)
    least = {}
    for d, f in rows:
        least[root(f)] = min(d, least.get(root(f), d))
    return sorted((d, f"{f:016x}", least[root(f)]) for d, f in rows)


def ran(spark, rows, more=""):
    docs = spark.createDataFrame(rows, "doc_id long, text string" + more)
    out = simhash.simhash_duplicates(docs)
    return sorted(tuple(r) for r in out.select("doc_id", simhash.fingerprint_text("fp"), "component_id").collect())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB c\t\n É\U0001f600", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow(text)


def test_long_text():
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdefgh") for _ in range(simhash.SHINGLES + 100))
    assert simhash.fingerprint(text) == slow(text)


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries()["op11_simhash_trie"](spark, SF)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "string", "bigint"]
    assert sorted(tuple(r) for r in got.collect()) == grouped([(r.doc_id, slow(r.text)) for r in docs])


def test_nulls_blanks_repeats_and_columns(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "a b", 0), (4, "a b", 0), (5, "A  B", 0), (6, "q w e r t y u i o", 0), (6, "other text of one id", 0), (None, "a b", 0)]
    want = grouped([(d, slow(t)) for d, t, _ in rows if d is not None])
    assert ran(spark, rows, ", fp int") == want
    assert {c for d, f, c in want if f == "0" * 16} == {1}
    assert ran(spark, []) == []


def planted(n, seed):
    """Fingerprints in chains of few differing bits, some of them dense."""
    rng = random.Random(seed)
    out = [0, (1 << 64) - 1]
    while len(out) < n:
        x = rng.choice(out[-20:]) if rng.random() < 0.8 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 4, 5, 5, 6])):
            x ^= 1 << b
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize(("budget", "parts", "hot"), [(4, 6, 20_000), (4, 5, 20_000), (3, 4, 20_000), (0, 1, 20_000), (4, 6, 7), (4, 5, 3)])
def test_links_against_all_pairs(spark, monkeypatch, budget, parts, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "LEAF", 4)
    fps = planted(600, parts)
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), budget, parts).collect()
    assert all((r.a ^ r.b) & (2**64 - 1) and ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= budget for r in links)
    from tidemark.llm.components import components

    label = {f: f for f, in signed}
    if links:
        label |= {r.node: r.component for r in components(spark.createDataFrame([tuple(r) for r in links], "a long, b long")).collect()}
    firsts = {}
    for f, in signed:
        firsts.setdefault(label[f], []).append(f)
    want = {}
    for d, _, c in grouped(list(enumerate(fps)), budget):
        want.setdefault(c, []).append(signed[d][0])
    assert sorted(map(sorted, firsts.values())) == sorted(map(sorted, want.values()))


def test_dense_node_gives_a_forest():
    rng = np.random.default_rng(3)
    v = np.unique(np.array([sum(1 << int(b) for b in rng.choice(40, 3, replace=False)) for _ in range(3000)], np.uint64))
    i, j = (np.concatenate(x) for x in zip(*simhash.near_pairs(v, np.array([0]), np.array([len(v)]), 20, 4)))
    full = np.triu(np.bitwise_count(v[:, None] ^ v[None, :]) <= 4, 1)
    assert len(set(zip(i.tolist(), j.tolist()))) == len(i) == full.sum()


def test_parts_must_exceed_the_budget():
    with pytest.raises(ValueError):
        simhash.Orders(4, 4)
