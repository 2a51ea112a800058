from collections import defaultdict
from math import log

import pytest
from pyspark.sql import functions as F

from tidemark.llm import imatch


def shared_buckets(spark):
    """Pairs of terms whose hashes are equal in the last 20 bits."""
    by = defaultdict(list)
    for r in spark.range(8000).selectExpr("concat('t', id) as t", "xxhash64(concat('t', id)) as h").collect():
        by[r.h % (1 << 20)].append(r.t)
    return [v for v in by.values() if len(v) > 1]


def test_terms_that_share_a_bucket_are_counted_apart(spark):
    (often, rare), (once, other) = (v[:2] for v in shared_buckets(spark)[:2])
    rows = [(i, often + (f" {rare}" if i < 3 else f" {once}" if i == 5 else f" {other}" if i == 6 else "")) for i in range(60)]
    got = {r.doc_id: r.fingerprint for r in imatch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] and got[0] == got[1] == got[2]
    assert all(got[i] == [] for i in range(3, 60))


def test_no_stranger_gets_in(spark):
    rows = [(i, " ".join(f"p{i // 2 * 30 + j} q{i * 30 + j}" for j in range(30))) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = imatch.Lexicon(df)
    noted = imatch.id_text(df).join(lexicon.notes(), "doc_id", "left")
    kept = {r.doc_id: set(r.t) for r in noted.select("doc_id", imatch._terms("text", lexicon.often, "note").alias("t")).collect()}
    hashed = {r.t: r.h for r in spark.createDataFrame([(w,) for _, t in rows for w in t.split()], "t string").selectExpr("t", "xxhash64(t) as h").collect()}
    assert kept == {d: {hashed[w] for w in t.split() if w[0] == "p"} for d, t in rows}


@pytest.mark.parametrize("band", [(0.15, 0.97), (0.3, 0.6), (0.0, 0.5), (0.9, 1.0)])
def test_other_bands(spark, band):
    """Rare terms of more than two documents are found by a join; those above the band by buckets."""
    rows = [(i, " ".join(f"w{j}" for j in range(40) if i % (j + 1) == 0)) for i in range(60)] + [(7, "w1 w39 again"), (61, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    counts, n = {}, len(rows)
    for _, t in rows:
        for w in set((t or "").split()):
            counts[w] = counts.get(w, 0) + 1
    inside = {w for w, c in counts.items() if band[0] <= log(n / c) / log(n) <= band[1]}
    lexicon = imatch.Lexicon(df, band)
    got = imatch.id_text(df).join(lexicon.notes(), "doc_id", "left").select("doc_id", "text", F.size(imatch._terms("text", lexicon.often, "note")).alias("n")).collect()
    assert sorted((r.doc_id, r.text, r.n) for r in got) == sorted((d, t or "", len(inside & set((t or "").split()))) for d, t in rows)


@pytest.mark.parametrize("window", [40, 1])
def test_terms_around_the_cuts(spark, monkeypatch, window):
    """Edited texts that equal another document's text have its fingerprint, also where cuts make words of the lexicon."""
    monkeypatch.setattr(imatch, "WINDOW", window)
    rows = [(9, "alpha beta gam"), (8, "ma delta"), (7, "alpha beta gma d"), (6, "gma d"), (5, "x yx y"), (4, "gmax alpha"), (3, "alpha beta"), (2, "ΟΔΟΣ ΟΔΟΣ'Α d"), (1, "beta"), (0, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in imatch.compared_with_edits(df).collect()}
    texts = [t for _, t in rows] + [r.edited for r in got.values()]
    plain = {}
    for t in texts:  # each edited text as a document of its own would be read: by the same lexicon
        one = spark.createDataFrame([(100, t)], "doc_id long, text string")
        plain[t] = one
    lexicon = {r.h for r in imatch.Lexicon(df).terms.collect()}
    for r in got.values():
        (hashes,) = plain[r.edited].select(F.expr("array_compact(" + f"transform(split(lower(text), r'{imatch.TERM_BREAK}'), t -> if(t = '', null, xxhash64(t)))" + ")").alias("h")).collect()
        (whole,) = spark.createDataFrame([(sorted({h for h in hashes.h if h in lexicon}),)], "t array<bigint>").select(F.expr("concat('all.', hex(xxhash64(t)))").alias("w")).collect()
        assert r.edited_fingerprint_whole[0] == whole.w, r
