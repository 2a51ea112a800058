import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa

from tidemark.llm import importance as I
from tidemark.llm.queries import queries


def test_features_depend_on_words_and_shapes():
    def grams(text):
        return collections.Counter(I.features(pa.array(["pad pad", text]))[1][I.features(pa.array(["pad pad", text]))[0] == 1].tolist())

    assert grams("The cat") == grams("The cat") and grams("the cat") != grams("The cat")
    same = grams("cat.") & grams("CAT!!")
    assert sum(same.values()) == 3  # the word, the length and the repeats, not the shape
    assert sum(grams("abc").values()) == 4 and not grams("") and sum(grams("$$ ||").values()) == 5
    assert sum(grams("a b c").values()) == 3 + 1 + 1 + 2 + 2  # words, one shape, one pair of shapes, pairs of words, length and repeats
    assert sum((grams("a b a b") & grams("a a b a b")).values()) == 2 + 1 + 1 + 2 + 1 and set(grams("a b a").values()) == {1}


def test_kth_largest_by_counting(spark, monkeypatch):
    monkeypatch.setattr(I, "LAST_ROWS", 5)
    r = random.Random(4)
    rows = [(i, r.choice([0.0, 1.0, r.random() * 10**r.randrange(5), -3.5])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, v double").repartition(3)
    order = sorted(rows, key=lambda x: (-x[1], x[0]))
    for k in (1, 2, 7, 150, 260, 333, 399):
        value, tie = I.kth_largest(df, "v", k)
        assert {i for i, v in rows if v > value or (v == value and i <= tie)} == {i for i, _ in order[:k]}, k
    assert I.kth_largest(df, "v", 0) is None and I.kth_largest(df, "v", 400)[0] == -math.inf


def held_out(spark, path):
    labels = spark.read.parquet(f"{path}/labels.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    got = {r.doc_id: r for r in I.resampled(docs, labels.where("doc_id % 2 = 0")).collect()}
    test = [r for r in labels.where("doc_id % 2 = 1").collect()]
    rate = lambda rows: sum(got[r.doc_id].sampled for r in rows) / max(1, len(rows))
    return rate([r for r in test if r.quality == 1 and r.toxic == 0]), rate([r for r in test if r.quality == 0]), rate([r for r in test if r.toxic == 1]), got


def test_held_out_accuracy(spark):
    clean, junk, toxic, got = held_out(spark, "/root/testdata/sf0.1")
    print("kept: clean", clean, "junk", junk, "toxic", toxic)
    assert clean > 0.98 and junk < 0.1 and toxic < 0.5  # half of 4,000 labels; toxic words are rarer than junk's marks
    for r in list(got.values())[:50]:
        u = (int(hashlib.md5(f"7:{r.doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        assert abs(r.key - r.log_weight + math.log(-math.log(u))) < 1e-9


def plain_features(text):
    """The features of a text as readable names, by regular expressions."""
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
    kind = lambda c: "a" if c.islower() or ord(c) > 127 else "A" if c.isupper() else "1" if c.isdigit() else c
    shape = ["".join(k for k, _ in itertools.groupby(map(kind, t))) for t in tokens]
    word = ["".join(c for c in t if c.isalnum() or ord(c) > 127).lower() for t in tokens]
    one = {("word", w) for w in word if w} | {("shape", s) for s in shape} | {("shapes", a, b) for a, b in zip(shape, shape[1:])}
    if tokens:
        one |= {("again", 8 * sum(a == b for a, b in zip(tokens, tokens[1:])) // len(tokens)), ("length", len(tokens).bit_length() - 1)}
    return one, {("words", a, b) for a, b in zip(word, word[1:]) if a and b}


def test_models_against_brute_force(spark):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice(["good", "fine", "Nice.", "to 4"]) for _ in range(60)) if i % 3 else " ".join(r.choice(["BAD!!", "good", "trash", "trash- 77"]) for _ in range(60))) for i in range(480)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 480, 2)]
    df, told = spark.createDataFrame(rows, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in I.resampled(df, told).collect()}
    targets = set(I.target_ids(told).tolist())
    assert targets < {i for i, q, _ in labels if q} and len(targets) > 80
    feats = {i: plain_features(t) for i, t in rows}
    weight = collections.Counter()
    for part in (0, 1):
        raw, good = collections.Counter(), collections.Counter()
        for i, f in feats.items():
            raw.update(f[part])
            if i in targets:
                good.update(f[part])
        share = sum(good.values()) / sum(raw.values())
        for f, c in raw.items():
            e = c * share
            w = math.log((good[f] + I.SMOOTH) / (e + I.SMOOTH))
            if abs(good[f] - e) >= I.LEAST_Z * math.sqrt(e + 1) and abs(w) >= I.LEAST_LOG:
                for i in feats:
                    weight[i] += w * (f in feats[i][part])
    assert any(weight.values())
    for i in feats:
        assert abs(got[i].log_weight - weight[i]) < 1e-3
    held = [i for i, _, _ in labels if i not in targets and (i % 3 or i in {x.doc_id for x in told.where(I._held_out()).collect()})]
    cut = I.cut_between(np.array([got[i].log_weight for i in held if i % 3]), np.array([got[i].log_weight for i in held if not i % 3]))
    k = sum(x.log_weight >= cut for x in got.values())
    assert sum(x.sampled for x in got.values()) == k == 320
    order = sorted(got.values(), key=lambda x: (-x.key, x.doc_id))
    assert {x.doc_id for x in got.values() if x.sampled} == {x.doc_id for x in order[:k]}


def test_many_rows_of_one_id_or_value(spark, monkeypatch):
    monkeypatch.setattr(I, "LAST_ROWS", 50)
    same = spark.createDataFrame([(7, 1.5)] * 300 + [(8, 1.5)] * 10 + [(9, 2.5)], "doc_id long, v double")
    assert I.kth_largest(same, "v", 100) == (1.5, 7) and I.kth_largest(same, "v", 305) == (1.5, 8)
    far = [-(1 << 63), -(1 << 62), (1 << 62) + 1, (1 << 62) + 2, (1 << 63) - 1] + list(range(200))
    ties = spark.createDataFrame([(i, 0.25) for i in far], "doc_id long, v double")
    for k in (1, 2, 3, 150, 203, 204):
        assert I.kth_largest(ties, "v", k) == (0.25, sorted(far)[k - 1])
    close = [(i, math.nextafter(1.0, 2.0) if i % 3 == 0 else 1.0) for i in range(300)]
    value, tie = I.kth_largest(spark.createDataFrame(close, "doc_id long, v double"), "v", 150)
    assert value == 1.0 and sum(v > value or (v == value and i <= tie) for i, v in close) == 150


def test_the_cut_parts_held_out_labels():
    cut = I.cut_between(np.array([3.0, 4.0, 5.0, -1.0]), np.array([-9.0, -8.0, 3.5, -0.5]))
    assert cut == -4.5  # all good ones and two bad ones above
    assert I.cut_between(np.array([-7.0] + [3.0] * 99), np.array([-5.0] * 4 + [9.0])) == -1.0  # one of 100 good ones is worth less than 4 of 5 bad ones
    assert I.cut_between(np.array([1.0]), np.zeros(0)) == -math.inf == I.cut_between(np.zeros(0), np.array([1.0]))


def test_small_tables(spark):
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(None, "a", 1), (1, None, 1), (2, "", 1), (3, "x " * 100_000, 1), (3, "x " * 100_000, 1)], "doc_id long, text string, quality int")
    assert sorted((r.doc_id, r.log_weight, r.sampled) for r in I.resampled(df, labels).collect()) == [(1, 0.0, True), (2, 0.0, True), (3, 0.0, True), (3, 0.0, True)]
    assert I.resampled(df.limit(0), labels.limit(0)).count() == 0
    assert I.resampled(df, labels, k=0).where("sampled").count() == 0


def test_query_on_table(spark):
    path = "/root/testdata/sf0.001"
    assert queries()["op7_importance_resampling"](spark, path).count() == spark.read.parquet(f"{path}/documents.parquet").count()
