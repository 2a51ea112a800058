import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import kernels as K
from tidemark.llm import mixing as M
from tidemark.llm.queries import queries


def unit(d, seed=11):
    return (int(hashlib.md5(f"{seed}:{d}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def brute(rows, powers=M.POWERS, keep=M.KEEP, targets=None):
    """rows: (doc_id, source, lang, topic, tokens).  Plain dictionaries, many rounds, scale by halving."""
    cells = collections.Counter()
    for _, s, la, t, n in rows:
        cells[(s, la, t)] += n
    total = sum(cells.values())
    goals = []
    for i, d in enumerate(M.DIMENSIONS):
        sums = collections.Counter()
        for c, n in cells.items():
            sums[c[i]] += n
        raised = {k: (v / total) ** powers[d] for k, v in sums.items() if v}
        wanted = (targets or {}).get(d)
        if wanted:
            others = sum(v for k, v in raised.items() if k not in wanted)
            raised = {k: wanted[k] if k in wanted else v / others * (1 - sum(wanted.values())) for k, v in raised.items()}
        goals.append({k: v / sum(raised.values()) * total for k, v in raised.items()})
    x = {c: float(n) for c, n in cells.items()}
    for _ in range(400):
        for i in range(3):
            have = collections.Counter()
            for c, v in x.items():
                have[c[i]] += v
            x = {c: v * (goals[i][c[i]] / have[c[i]] if have[c[i]] else 1) for c, v in x.items()}
    ratio = {c: x[c] / n for c, n in cells.items() if n}
    low, high = 0.0, 1e6
    for _ in range(200):
        s = (low + high) / 2
        if sum(n * min(1, s * ratio[c]) for c, n in cells.items() if n) < keep * total:
            low = s
        else:
            high = s
    return {c: min(1, high * ratio[c]) if n else 1.0 for c, n in cells.items()}


def vector(text):
    v = np.zeros(M.DIMS)
    for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()):
        if len(w) > 4:
            h = int(K.Words(pa.array([w.decode()]), lower=True).hash[0])
            v[h % M.DIMS] += -1 if h >> 40 & 1 else 1
    return np.rint(127 * v / (np.sqrt(v @ v) or 1)).astype(int)


@pytest.mark.parametrize("most", [M.CELLS, 0])
def test_chances_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(M, "CELLS", most)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("source < 'src14'")
    targets = {"lang": {"en": 0.5, "xx": 0.1}} if most else {"source": {"src0": 0.3}}
    got = M.mixed(docs, targets=targets).collect()
    given = {r.doc_id: r for r in docs.collect()}
    topic = {r.doc_id: r.topic for r in got}
    rows = [(r.doc_id, r.source, r.lang, topic[r.doc_id], len(re.findall(rb"[^\x20\x09-\x0D]+", r.text.encode()))) for r in given.values()]
    # a wanted name without tokens leaves its share to all the others, in proportion
    want = brute(rows, targets={"lang": {"en": 0.5 / 0.9}} if most else targets)
    assert sorted((r.doc_id, r.source, r.lang, r.tokens) for r in got) == sorted((d, s, la, n) for d, s, la, _, n in rows)
    for r in got:
        assert abs(r.chance - want[(r.source, r.lang, r.topic)]) < 1e-4
        assert r.sampled == (unit(r.doc_id) < r.chance)
    kept = sum(r.tokens * r.chance for r in got) / sum(r.tokens for r in got)
    assert abs(kept - M.KEEP) < 1e-6


def test_topics_are_the_clusters_of_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.topic for r in M.described(docs).collect()}
    vectors = {d: vector(t) for d, t in texts.items()}
    rows = M.written(M.id_text(docs, keep=["source", "lang"]).mapInArrow(M._vectors, M._DESCRIBED), "vectors")
    assert all((np.frombuffer(r.vector, np.int8) == vectors[r.doc_id]).all() for r in rows.collect())
    order = [r.doc_id for r in docs.where("doc_id is not null").selectExpr("doc_id", "xxhash64(doc_id) as h").orderBy("h").collect() if vectors[r.doc_id].any()]
    unit_of = lambda s: np.rint(1000 * s / (np.sqrt((s.astype(float) ** 2).sum()) or 1)).astype(int)
    seeds = [unit_of(vectors[d]) for d in order[: M.SEEDS]]
    centres = [seeds[0]]
    while len(centres) < M.TOPICS:
        far = [max(int(s @ c) for c in centres) for s in seeds]
        centres.append(seeds[int(np.argmin(far))])
    for _ in range(M.TURNS):
        of = {d: int(np.argmax([int(v @ c) for c in centres])) for d, v in vectors.items() if v.any()}
        centres = [unit_of(sum(vectors[d] for d in of if of[d] == t)) if t in of.values() else c for t, c in enumerate(centres)]
    want = {d: str(int(np.argmax([int(v @ c) for c in centres]))) if v.any() else "-1" for d, v in vectors.items()}
    assert got == want and len(set(got.values())) > 2


def test_a_topic_column_and_targets_for_it(spark):
    rows = [(i, "word " * 10, "s", "en", "ab"[i % 2]) for i in range(400)] + [(999, "word", "s", "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, subject string")
    got = M.mixed(df, targets={"topic": {"a": 0.8, "b": 0.2}}, keep=0.5, topic_column="subject").collect()
    chance = {r.topic: r.chance for r in got}
    assert set(chance) == {"a", "b", M.NONE} and abs(chance["a"] / chance["b"] - 4) < 1e-3


def test_raked_marginals_meet_their_targets():
    r = np.random.default_rng(1)
    cells = r.integers(0, 1000, 20 * 4 * 8).astype(float)
    index = [np.repeat(np.arange(20), 32), np.tile(np.repeat(np.arange(4), 8), 20), np.tile(np.arange(8), 80)]
    targets = [np.full(n, cells.sum() / n) for n in (20, 4, 8)]
    x = M.rake(cells, index, targets)
    for i, t in zip(index, targets):
        assert np.allclose(np.bincount(i, x), t, rtol=1e-4)
    for keep in (0.0, 0.3, 0.9, 1.0):
        ratio = np.divide(x, cells, out=np.zeros_like(x), where=cells > 0)
        s = M.scale_for(lambda s: (cells[s * ratio >= 1].sum(), (cells * ratio)[s * ratio < 1].sum()), keep * cells.sum())
        assert abs((cells * np.minimum(1, s * ratio)).sum() - keep * cells.sum()) < 1e-6 * cells.sum()


def test_small_tables(spark):
    rows = [(None, "a", "s", "en"), (1, None, None, None), (2, "", "s", "en"), (3, "alpha beta", "s", "en"), (3, "alpha beta", "s", "en"), (4, "gamma " * 50_000, "t", None)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, lang string, tokens int")
    got = sorted((r.doc_id, r.source, r.lang, r.topic == "-1", r.tokens) for r in M.mixed(df).collect())
    assert got == [(1, "(none)", "(none)", True, 0), (2, "s", "en", True, 0), (3, "s", "en", False, 2), (3, "s", "en", False, 2), (4, "t", "(none)", False, 50_000)]
    assert M.mixed(df.limit(0)).count() == 0


def test_query_on_table(spark):
    got = queries()["op10_mixing_weights"](spark, "/root/testdata/sf0.01").collect()
    n = sum(r.tokens for r in got)
    assert len(got) == 1000 and abs(sum(r.tokens for r in got if r.sampled) / n - M.KEEP) < 0.1
