import hashlib
import random
import re
from statistics import mean

from tidemark.llm import imatch
from tidemark.llm.imatch import compared_with_edits
from tidemark.llm.queries import queries


def edits(rows):
    order = sorted(((d, t or "") for d, t in rows if d is not None), key=lambda r: (-r[0], r[1]))
    out = []
    for i, (d, t) in enumerate(order):
        nxt, k = order[(i + 1) % len(order)][1], len(t) // 3
        out.append((d, len(t), t[: len(t) - k] + nxt[:k]))
    return sorted(out)


def test_edited_texts_over_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(imatch, "STRETCH", 3)
    r = random.Random(1)
    ids = [*range(40), *[10**12 + r.randrange(10**6) for _ in range(30)], -5, 7]
    rows = [(d, r.choice([None, "", "é😀x" * r.randrange(9), " ".join(r.choice("abcdefg") * 3 for _ in range(40))])) for d in ids] + [(None, "x")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, s int").repartition(4)
    got = compared_with_edits(df).collect()
    assert sorted((g.doc_id, g.n_chars, g.edited) for g in got) == edits(rows)
    assert all(0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1 for g in got)


def test_small_tables(spark):
    one = compared_with_edits(spark.createDataFrame([(3, "abcdef gh")], "doc_id long, text string")).collect()
    assert [(g.doc_id, g.n_chars, g.edited) for g in one] == [(3, 9, "abcdefabc")]
    assert compared_with_edits(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fingerprint_is_a_hash_of_lexicon_terms_in_subsets(spark):
    rows = [(i, " ".join(f"w{(i * 7 + j) % 90}" for j in range(20))) for i in range(60)] + [(100, "unknown"), (101, "W1, w1! w2"), (102, "w2 w1")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    have = {r.h for r in imatch.Lexicon(df).terms.collect()}
    hashed = {r.t: r.h for r in spark.createDataFrame([(f"w{i}",) for i in range(90)], "t string").selectExpr("t", "xxhash64(t) as h").collect()}
    counts = {}
    for _, t in rows:
        for b in {hashed[w] for w in re.findall(r"w\d+", t.lower())}:
            counts[b] = counts.get(b, 0) + 1
    n = len(rows)
    from math import log

    band = {b for b, c in counts.items() if imatch.BAND[0] <= log(n / c) / log(n) <= imatch.BAND[1]}
    assert band == {b for b in have if b in counts}
    got = {r.doc_id: r for r in imatch.fingerprints(df).collect()}
    assert got[101].fingerprint == got[102].fingerprint
    for d, t in rows[:60]:
        terms = sorted({hashed[w] for w in t.split() if hashed[w] in have})
        level = (len(terms) - 1).bit_length() if terms else 0
        slots = {(lv, ((h % (1 << 64)) >> 22) % (1 << lv)) for h in terms for lv in ({level, level - 1} if level else {0})}
        want = sorted(f"{lv}.{s}" for lv, s in slots if s < imatch.SLOTS)
        assert sorted(x.rsplit(".", 1)[0] for x in got[d].fingerprint) == want


def test_query_on_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    df = queries()["op9_imatch_fingerprints"](spark, path)
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())
    got = df.collect()
    assert sorted((g.doc_id, g.n_chars, g.edited_sha256) for g in got) == [(d, n, hashlib.sha256(t.encode()).hexdigest()) for d, n, t in edits(rows)]
    text = dict(rows)
    same = {}
    for g in got:
        assert same.setdefault(text[g.doc_id], g.fingerprint) == g.fingerprint
    long = [g for g in got if g.n_chars > 300]
    print("near_edited", mean(g.near_edited for g in long), "near_next", mean(g.near_next for g in long))
    assert mean(g.near_edited for g in long) > 0.25 and mean(g.near_next for g in long) < 0.05
    assert sum(g.near_edited > g.near_next for g in long) > 0.95 * len(long)
