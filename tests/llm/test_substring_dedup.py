import hashlib
import random
import re

import pytest

from tidemark.llm.queries import queries
from tidemark.llm import substring_dedup as S
from tidemark.llm.substring_dedup import remove_repeats, repeated_paths

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, k=13):
    words = [(d, WORD.findall((t or "").encode())) for d, t in rows if d is not None]
    owner = {}
    for d, w in words:
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            owner[key] = min(d, owner.get(key, d))
    out = {}
    for d, w in words:
        gone = set()
        for i in range(len(w) - k + 1):
            if owner[tuple(w[i : i + k])] < d:
                gone.update(range(i, i + k))
        out[d] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return out


def fixture():
    r = random.Random(5)
    vocab = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(40)]
    passage = [r.choice(vocab) for _ in range(60)]
    rows = [(0, None), (1, ""), (2, "  \n\t "), (3, "one two three")]
    for d in range(4, 90):
        w = [r.choice(vocab) for _ in range(r.choice([5, 12, 13, 40, 200]))]
        if d % 3 == 0:
            a = r.randrange(40)
            w[r.randrange(len(w)) : 0] = passage[a : a + r.randrange(10, 40)]
        sep = r.choice([" ", "\n", "  ", " \x0b"])
        rows.append((d, sep.join(w) + r.choice(["", " ", "\n"])))
    rows += [(200 + i, rows[20 + i][1]) for i in range(5)] + [(300, "x " * 5000), (301, "x " * 40)]
    return rows


def test_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for _ in range(1):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(df).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("hot, batch", [(0, 1 << 19), (20_000, 1), (3, 500)])
def test_hot_minimizers_and_small_batches(spark, monkeypatch, hot, batch):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "BATCH", batch)
    monkeypatch.setattr(S, "FLUSH_EDGES", 300)
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(df).collect()} == brute(rows)


def test_repeated_passages_are_whole(spark):
    r = random.Random(3)
    words = lambda n: [f"u{r.randrange(10**9)}" for _ in range(n)]
    a, b, c = words(120), words(70), words(30)
    texts = {1: words(20) + a + words(5), 2: words(9) + a + b, 3: b + words(40) + c, 4: c + words(3), 5: a[:80] + words(30), 6: words(90)}
    df = spark.createDataFrame([(d, " ".join(t)) for d, t in texts.items()], "doc_id long, text string").repartition(3)
    got = sorted((x.doc_id, x.start, x.n_words) for x in repeated_paths(df).collect())
    # a is cut where document 5 leaves it: the paths before and after are of different documents
    assert [x for x in got if x[0] == 1][0][1] == 20 and (2, 129, 70) in got and not any(d in (3, 4, 5, 6) for d, _, _ in got)
    assert {x for d, s, n in got if d == 1 for x in range(s, s + n)} == set(range(20, 140))
    assert [(x.doc_id, x.n_words) for x in repeated_paths(df.where("doc_id in (3, 4)"), least_words=13).collect()] == [(3, 30)]
    assert repeated_paths(df.limit(0)).count() == 0


def test_graph_paths_end_at_branches():
    import numpy as np

    flat = np.array([1, 2, 3, 4, 2, 3, 4, 5, 9, 3, 4])  # 1-2-3-4, 2-3-4-5, 9-3-4
    g = S._Graph(flat, np.array([3, 3, 2]))
    assert g.begin.tolist() == [True, True, True, True, True, True, True, True]
    g = S._Graph(np.array([1, 2, 3, 4, 1, 2, 3, 4, 8, 9]), np.array([3, 3, 1]))
    assert g.begin.tolist() == [True, False, False, True, False, False, True] and g.least(np.array([5, 5, 5, 2, 2, 2, 7])).tolist() == [2] * 6 + [7]


def test_edges_of_tables(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    text = " ".join(f"a{i}" for i in range(20))
    df = spark.createDataFrame([(None, text, 1), (1, text, 2), (1, text, 2), (2, text, None)], "doc_id long, text string, start int")
    got = sorted((r.doc_id, r.n_removed) for r in remove_repeats(df).collect())
    assert got == [(1, 0), (1, 0), (2, 20)]


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_on_table(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    want = {d: (n, g, hashlib.sha256(t.encode()).hexdigest()) for d, (n, g, t) in brute(rows).items()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries()["op2_substring_dedup"](spark, path).collect()}
    assert got == want


def test_one_id_with_several_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    lone = " ".join(f"z{i}" for i in range(60))
    rows = [(1, a), (2, b + " " + a), (2, "short"), (2, b), (2, b), (4, lone), (5, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(df).collect())
    assert got == sorted([(1, 30, 0, a), (2, 60, 30, b), (2, 1, 0, "short"), (2, 30, 0, b), (2, 30, 0, b), (4, 60, 0, lone), (5, 30, 30, "")])
