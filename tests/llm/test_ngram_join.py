import random
import re

import pytest

from tidemark.llm import ngram_join
from tidemark.llm.components import components
from tidemark.llm.ngram_join import similar_documents
from tidemark.llm.queries import queries

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
UPPER = bytes(range(65, 91))


def sets_of(rows, k=5):
    out = {}
    for d, t in rows:
        if d is None:
            continue
        w = WORD.findall((t or "").encode().translate(bytes.maketrans(UPPER, UPPER.lower())))
        out[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def brute(rows, k=5, percent=80):
    sets = sets_of(rows, k)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    holders = {}
    for d in ids:
        for s in sets[d]:
            holders.setdefault(s, []).append(d)
    seen = set()
    for members in holders.values():
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                        x, y = root(a), root(b)
                        parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def fixture():
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(500)]
    passage = [r.choice(vocab) for _ in range(80)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "a b"), (4, "A  B"), (5, "a b c d e"), (6, "a B c D e")]
    base = [[r.choice(vocab) for _ in range(r.choice([8, 60, 200]))] for _ in range(30)]
    for d in range(10, 300):
        w = list(base[r.randrange(30)])
        if d % 4 == 0:
            w = [r.choice(vocab) for _ in range(r.choice([3, 30, 100]))]
        for _ in range(r.choice([0, 1, 2, 4, 8])):
            w[r.randrange(len(w))] = r.choice(vocab)
        if d % 5 == 0:
            w[r.randrange(len(w)) : 0] = passage
        rows.append((d, " ".join(w)))
    hot = [r.choice(vocab) for _ in range(120)]
    for d in range(400, 520):  # a large group of near copies, not all within reach of one
        w = list(hot)
        for _ in range(r.choice([1, 2, 3])):
            w[r.randrange(len(w))] = r.choice(vocab)
        rows.append((d, " ".join(w)))
    return rows


def test_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(df).collect()}
    assert got == brute(rows)


def test_other_thresholds_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rows = fixture()[::2]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(df, 3, 60).collect()}
    assert got == brute(rows, 3, 60)


@pytest.mark.parametrize("most", [1, 3])
def test_hot_postings_are_dealt_in_slices(spark, monkeypatch, most):
    monkeypatch.setattr(ngram_join, "HOT", most)
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    heavy = ngram_join.heavy_shingles(ngram_join.id_text(df), 5)
    hot = ngram_join.hot_postings(spark, heavy).collect()
    assert hot and all(r.slices > 1 for r in hot)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(df).collect()}
    assert got == brute(rows)


def test_edges_of_tables(spark):
    assert similar_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(None, "a b c", 1), (1, "a b c", 2), (1, "a b c", 2), (2, "A B C", None)], "doc_id long, text string, n int")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(df).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1)]


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 103), (103, 101), (103, 103), (100, 103)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100, 103: 100}


def test_query_on_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries()["op1_ngram_jaccard_join"](spark, path).collect()}
    assert got == brute(rows)


def test_one_id_with_several_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, a + " more"), (2, b), (2, b), (2, None), (5, b), (0, c), (7, c + " c"), (2, c)]
    got = sorted((r.doc_id, r.n_shingles, r.class_id, r.component_id) for r in similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert got == sorted([(1, 36, 1, 1), (2, 37, 2, 1), (2, 36, 2, 2), (2, 36, 2, 2), (2, 0, 2, 2), (5, 36, 2, 2), (0, 36, 0, 0), (7, 37, 7, 0), (2, 36, 0, 0)])
