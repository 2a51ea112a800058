import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling
from tidemark.llm.queries import queries

SF = "/root/testdata/sf0.001"


def counted(docs):
    found = Counter()
    for d, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_letter(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow(words):
    """Rows by looking at the words that share a text with one letter taken out."""
    under = {}
    for w in words:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            under.setdefault(x, []).append(w)
    near = {w: set() for w in words}
    for ws in under.values():
        for a, b in itertools.permutations(ws, 2):
            if one_letter(a, b):
                near[a].add(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def ran(spark, docs, more=""):
    out = spelling.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string" + more))
    return sorted(tuple(r) for r in out.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries()["op13_spelling_variants"](spark, SF)
    assert [f.dataType.simpleString() for f in got.schema] == ["string"] * 3 + ["bigint"] * 3
    assert sorted(tuple(r) for r in got.collect()) == slow(counted(docs))


def family(seed):
    """Texts of words that are one or two letters apart, in falling frequency, some with letters beyond ASCII."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcé×ÀZ") for _ in range(rng.randint(5, 9))): 3000 for _ in range(4)}
    for n in (500, 80, 14, 5):
        for w in list(words):
            for _ in range(4):
                i, c = rng.randrange(len(w) + 1), rng.choice("abcdÿ")
                words.setdefault(rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :]]) or "a", n)
    return [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]


@pytest.mark.parametrize(("crowd", "short"), [(256, 64), (0, 64), (3, 0), (256, 7)])
def test_variants_against_brute_force(spark, monkeypatch, crowd, short):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    monkeypatch.setattr(spelling, "SHORT", short)
    docs = family(crowd)
    want = slow(counted(docs))
    assert any(form and root != form for _, form, root, *_ in want)
    assert ran(spark, docs) == want


def test_letters_in_all_orders(spark, monkeypatch):
    """Words of two letters in all orders: few keys, and no pairs but near ones."""
    monkeypatch.setattr(spelling, "CROWD", 50)
    words = {"".join(p): 5 for n in (7, 8) for p in itertools.product("ab", repeat=n)}
    near = spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n long"))
    rows = near.collect()
    assert len(rows) == len({(r.word, r.near) for r in rows}) == sum(x[4] for x in slow(words))
    assert spelling.listed(spark.createDataFrame(list(words.items()), "word string, n long")).groupBy("key", "way", "order").count().agg({"count": "max"}).first()[0] < 50


def test_nulls_repeats_and_columns(spark):
    docs = [(1, None, "x"), (2, "", "x"), (None, "walking " * 9, "x"), (3, "Walking wALKING walking walking walking", "x"), (3, "Walking wALKING walking walking walking", "x"), (4, "talking " * 60, "x"), (5, "walk-ing short " * 9, "x"), (6, "ÀÉÎÕÜ÷ àéîõü÷ " * 6, "x")]
    got = ran(spark, docs, ", word string")
    assert got == slow(counted([d[:2] for d in docs if d[0] is not None]))
    assert ("walking", "talking", "talking", 10, 1, 60) in got
    assert ran(spark, []) == ran(spark, [(1, None)]) == []


def test_long_words(spark):
    long = "ÿ" * 200_000
    docs = [(i, long) for i in range(5)] + [(i, long + "a") for i in range(9, 40)]
    assert [(len(a), len(b) if b else None, len(c), n, k) for a, b, c, n, k, _ in ran(spark, docs)] == [(len(a), len(b) if b else None, len(c), n, k) for a, b, c, n, k, _ in slow_long(docs)]


def slow_long(docs):
    return sorted((w, None if w.endswith("a") else max(counted(docs)), max(counted(docs)), n, 1, 31) for w, n in counted(docs).items())
